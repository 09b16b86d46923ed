"""Language of a text by hashed character n-grams.

A naive Bayes model over the first three and the last three letters of words; each such feature
counts once a text. The model is fitted on a sample text per language. Features are looked up in an
array by their hash, so one pass over the words serves all languages.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Mapping
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# What people write in reviews, and frequent words, for each language. All are in
# Latin letters; texts in other scripts are told by their letters.
SAMPLES: dict[str, str] = {
    "cs": "tato aplikace je velmi dobrá a doporučuji všem. super aplikace, skvělé, nejlepší. po "
          "aktualizaci to nefunguje, pořád padá a nejde se přihlásit. děkuji, moc hezké a "
          "přehledné. proč už to není jako dřív, co se stalo, jen reklamy. když chci, tak které "
          "který jsem jsou bylo byla ale nebo také ještě při před jeho",
    "da": "det er en rigtig god app og jeg bruger den hver dag. den virker ikke efter "
          "opdateringen, kan ikke logge ind. meget nem at bruge, anbefales, tak for hjælpen. "
          "hvorfor er der så mange reklamer, jeg er ikke tilfreds. dejlig, fantastisk, bedste. "
          "og af til har var blev ved også noget nogle kun fra men eller når skal",
    "de": "die app ist sehr gut und einfach zu bedienen, ich bin zufrieden. seit dem letzten "
          "update funktioniert nichts mehr, stürzt immer ab. kann mich nicht anmelden, bitte "
          "beheben. schlecht, leider zu viel werbung und zu teuer. beste, tolle, danke, schön, "
          "klasse, gerne wieder, gute guten guter gutes. der das den dem des ein eine einen von mit für auf aus bei nach "
          "wie auch nur aber oder wenn man sich es er sie wir ihr war wird sind hat haben als "
          "noch über durch mein kein diese alles geht läuft macht",
    "en": "this is a great app and i love it, very easy to use, highly recommend to everyone. "
          "good, nice, awesome, amazing, excellent, best app ever, works great, thank you so "
          "much. it keeps crashing after the last update and i can not log in to my account, "
          "please fix this. too many ads, waste of time and money, worst customer service, do "
          "not download. was were be been has have had would should could will just like when "
          "what which there their they them you your we our he she his her of for with on at by "
          "from as that but or if no yes all any some more most other than then now only also "
          "even after before every never always still back need want make made get got going "
          "really about because how why where who new old free game phone screen slow fast bad "
          "terrible horrible useless helpful simple cool fun perfect fine okay poor wonderful "
          "brilliant fantastic super superb top cheap decent stars star sound trash scam crashes crash constantly addictive useful uninstalled disappointed annoying issue problem working support love loved",
    "es": "la aplicación es muy buena y fácil de usar, me gusta mucho, la recomiendo. excelente, "
          "buenísima, me encanta, gracias, todo bien. desde la última actualización no funciona, "
          "se cierra sola y no puedo entrar en mi cuenta. pésimo servicio, mala, muy lenta, mucha "
          "publicidad. el los las un una unos del al con por para que como pero más cuando donde "
          "este esta esto ese son está están ser hay sin sobre también porque ya le lo su sus ha "
          "han fue y o si nada siempre hacer tiene bueno mejor",
    "fi": "tämä on todella hyvä sovellus ja helppo käyttää. erittäin hyvä, paras, kiitos, toimii "
          "hyvin. päivityksen jälkeen ei toimi, kaatuu koko ajan eikä pääse kirjautumaan. liikaa "
          "mainoksia, huono, en suosittele, hyvä. mutta että kun niin myös vain kuin ovat oli se joka "
          "jos ole sen mitä miksi nyt aina",
    "fr": "cette application est très bien et facile à utiliser, je recommande. super, géniale, "
          "parfait, merci, j'adore, excellente. depuis la dernière mise à jour elle ne marche "
          "plus, impossible de me connecter à mon compte. très mauvais service, trop de publicité, "
          "nul. le la les un une des du de et en dans pour par sur avec sans qui que quoi ce ces "
          "il elle nous vous ils est sont était pas mais ou si tout tous bien aussi être avoir "
          "fait peut au aux son sa ses leur plus comme même je tu on bon bonne",
    "hu": "ez egy nagyon jó alkalmazás és könnyű használni, ajánlom mindenkinek. szuper, kiváló, "
          "köszönöm, tetszik. a frissítés óta nem működik, nem tudok belépni. rossz, sok a "
          "reklám, lassú. hogy van volt csak még már vagy mint ha az nem meg kell minden olyan "
          "mert ki be el fel itt",
    "id": "aplikasi ini sangat bagus dan mudah digunakan, saya suka. mantap, bagus, keren, "
          "terima kasih, sangat membantu. setelah pembaruan tidak bisa masuk, selalu keluar "
          "sendiri, tolong diperbaiki. terlalu banyak iklan, jelek, lambat, kecewa. yang di ke "
          "dari untuk dengan pada adalah itu akan juga sudah belum kalau tapi karena lagi semua "
          "lebih bisa banget nya tidak ada",
    "it": "questa app è molto bella e facile da usare, la consiglio a tutti. ottima, ottimo, "
          "perfetta, bellissima, grazie, fantastica. dopo l'ultimo aggiornamento non funziona "
          "più, si blocca e non riesco ad accedere. pessima, lenta, troppa pubblicità. il lo gli "
          "un una di del della dei delle che chi con per tra sono è stato anche ma se come quando "
          "perché nel nella alla dal sul suo sua questo molto tutto sempre ho hanno essere fare "
          "bene buona buono",
    "nl": "dit is een hele goede app en makkelijk in gebruik, geweldig, geweldige, top. sinds de "
          "laatste update werkt het niet meer, kan niet inloggen en loopt steeds vast. erg "
          "handig, prima, dank je wel, leuk. slecht, te veel reclame, waardeloos, jammer. het de "
          "een van voor met op aan bij naar uit over ook maar als dan nog wel geen niet zijn was "
          "werd heeft hebben ik je jij wij zij deze die dat wat waar hoe jaar goed gaat veel heel",
    "pl": "ta aplikacja jest bardzo dobra i łatwa w użyciu, polecam wszystkim. super, świetna, "
          "najlepsza, dziękuję. po aktualizacji nie działa, ciągle się zawiesza i nie można się "
          "zalogować. słaba, za dużo reklam, dramat. że się na do od dla przez czy ale jak tak "
          "nie już tylko może być jest są był była które który gdy bo po co to tego tym",
    "pt": "o aplicativo é muito bom e fácil de usar, eu recomendo, adorei. ótimo, excelente, "
          "maravilhoso, obrigado, gostei muito. depois da atualização não funciona mais, não "
          "consigo entrar na minha conta, só trava. péssimo, horrível, muita propaganda. os as um "
          "uma do da dos das no na com por para que como mas mais quando onde este esta isso são "
          "está estão ser não sem também porque já seu sua foi tem ele ela você nada sempre fazer "
          "melhor bem",
    "ro": "această aplicație este foarte bună și ușor de folosit, o recomand. excelent, super, "
          "mulțumesc, îmi place. după actualizare nu mai merge, nu pot să intru în cont. slabă, "
          "prea multe reclame. și în cu la pe din pentru care că dar sau ca mai fi sunt este a fost "
          "au nu se ce când doar bine toate",
    "sv": "det här är en mycket bra app och lätt att använda, rekommenderas. jättebra, "
          "fantastisk, bäst, tack, älskar appen. efter senaste uppdateringen fungerar den inte, "
          "kan inte logga in. dålig, för mycket reklam, värdelös. och av till som med på för är "
          "var har hade inte jag du vi de men eller när också bara så kan ska från om vid ett den",
    "tr": "bu uygulama çok güzel ve kullanımı kolay, herkese tavsiye ederim. harika, süper, "
          "mükemmel, teşekkürler, bayıldım, çok iyi. son güncellemeden sonra açılmıyor, hesabıma "
          "giremiyorum, sürekli kapanıyor. berbat, kötü, reklam çok fazla, yavaş. bir ve için ile "
          "ama daha gibi olarak değil var yok ne nasıl neden her şey kadar sonra olan oldu en da de",
    "vi": "ứng dụng này rất tốt và dễ sử dụng, tôi rất thích. tuyệt vời, hay, cảm ơn, quá đẹp. sau "
          "khi cập nhật không vào được, bị lỗi liên tục. tệ, nhiều quảng cáo quá, chậm. và của là "
          "có cho các một những được trong với người đã đang sẽ thì mà như nhưng nếu rồi ai gì "
          "không phải",
}
UNDETERMINED = "und"
OTHER = "other"
BUCKETS = 2048
AFFIX = 3  # letters at either end of a word; a shorter word is its own feature
PRIOR = 0.5  # added to every feature's count
UNIT = 0.1  # nats; scores are whole numbers of it
MARGIN = 18  # units by which another language must exceed a preferred one
NOT_LETTERS = r"[^\p{L}]+"
NOT_FOREIGN = r"[\P{L}\p{IsLatin}]+"  # one class, so that a run is one step of the matcher


def features(words: list[str]) -> list[str]:
    """Beginnings and, marked, ends of words."""
    return [*[w[:AFFIX] for w in words], *[f">{w[-AFFIX:]}" for w in words]]


def fit(samples: Mapping[str, str]) -> dict[str, list[int]]:
    """Score of each feature for each language in the order of their names: log probability among
    the features of its kind, above that of the language where it is least."""
    names = sorted(samples)
    counts = {k: Counter(features(re.findall(r"[^\W\d_]+", samples[k].lower()))) for k in names}
    known = sorted(set().union(*counts.values()))

    def kind(feature: str) -> str:
        return feature[0] if feature[0] == ">" else "<"

    kinds = Counter(map(kind, known))
    totals = {k: Counter() for k in names}
    for k in names:
        for f, n in counts[k].items():
            totals[k][kind(f)] += n
    model = {}
    for f in known:
        logs = [math.log((counts[k][f] + PRIOR) / (totals[k][kind(f)] + PRIOR * kinds[kind(f)]))
                for k in names]
        model[f] = [round((x - min(logs)) / UNIT) for x in logs]
    return model


PACKED = 4  # languages whose scores share a 64-bit number


@lru_cache(maxsize=8)
def _table(samples: tuple[tuple[str, str], ...]) -> str:
    """The model as JSON: buckets of features by hash, each with its packed scores.
    A text shows a feature once at most, so the model bounds every sum it can come to."""
    model = fit(dict(samples))
    bits = 64 // PACKED
    if any(sum(scores) >> (bits - 1) for scores in zip(*model.values(), strict=True)):
        raise ValueError("these samples are too long for packed scores")
    buckets: list[list] = [[] for _ in range(BUCKETS)]
    for f, scores in model.items():
        slots = [sum(x << (bits * i) for i, x in enumerate(scores[j:j + PACKED]))
                 for j in range(0, len(scores), PACKED)]
        buckets[zlib.crc32(f.encode()) % BUCKETS].append({"f": f, "s": slots})
    return json.dumps(buckets, separators=(",", ":"))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _features(words: Column) -> Column:
    heads = F.array_distinct(F.transform(words, lambda w: F.left(w, F.lit(AFFIX))))
    tails = F.array_distinct(F.transform(words, lambda w: F.right(w, F.lit(AFFIX))))
    return F.concat(heads, F.transform(tails, lambda t: F.concat(F.lit(">"), t)))


def language_scores(text: Column, samples: Mapping[str, str] = SAMPLES) -> Column:
    """Array of ``(score, -order, lang)`` for every language, from the distinct words of a text in
    lower case; all scores are 0 where no feature is known."""
    names, bits = sorted(samples), 64 // PACKED
    # only literals go in, so the optimiser computes the array once for the query
    table = F.from_json(F.lit(_table(tuple(sorted(samples.items())))),
                        "array<array<struct<f: string, s: array<bigint>>>>")
    words = F.array_distinct(F.split(text, NOT_LETTERS))
    hits = F.flatten(F.transform(_bind(words, _features), lambda f: F.filter(
        F.get(table, F.pmod(F.crc32(f), F.lit(BUCKETS)).cast("int")), lambda e: e["f"] == f)))
    slots = F.sequence(F.lit(0), F.lit((len(names) - 1) // PACKED))
    sums = _bind(hits, lambda found: F.transform(slots, lambda j: F.aggregate(
        found, F.lit(0).cast("long"), lambda x, e: x + F.get(e["s"], j))))

    def unpack(packed: Column) -> Column:
        def score(i: Column) -> Column:
            slot = F.get(packed, F.floor(i / PACKED).cast("int"))
            shifted = F.call_function("shiftright", slot, F.lit(bits) * (i % PACKED))
            return shifted.bitwiseAND(F.lit((1 << bits) - 1))

        return F.transform(F.split(F.lit(" ".join(names)), " "), lambda name, i: F.struct(
            score(i).alias("score"), (-i).alias("order"), name.alias("lang")))

    return _bind(sums, unpack)


def detect_language(
    col: Column | str, samples: Mapping[str, str] = SAMPLES, prefer: str | None = None,
) -> Column:
    """Language of a text: the highest score, ties to the first name. A text most of whose letters
    are not Latin is of another language; one without letters, or without any known feature, is
    undetermined. A preferred language is given unless another exceeds its score by ``MARGIN``,
    which takes more than one word that it has in common with another language's sample.
    """
    text = F.coalesce(F.lower(F.col(col) if isinstance(col, str) else col), F.lit(""))

    def best(scores: Column) -> Column:
        top = F.array_max(scores)
        label = top["lang"]
        if prefer in samples:
            own = F.get(scores, F.lit(sorted(samples).index(prefer)))["score"]
            label = F.when(top["score"] - own < MARGIN, F.lit(prefer)).otherwise(label)
        return F.when(top["score"] == 0, UNDETERMINED).otherwise(label)

    def judge(lowered: Column) -> Column:
        foreign = F.length(F.regexp_replace(lowered, NOT_FOREIGN, ""))
        letters = F.length(F.regexp_replace(lowered, NOT_LETTERS, ""))
        plain = F.octet_length(lowered) == F.length(lowered)  # ASCII has no other script
        other = ~plain & (2 * foreign > letters)
        return F.when(other, OTHER).otherwise(_bind(language_scores(lowered, samples), best))

    return _bind(text, judge)
