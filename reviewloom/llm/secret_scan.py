"""Secret scans through an inverted index of trigrams.

Each rule's pattern is turned into alternatives of trigrams that any match must contain. The index
lists, for the rarest of those trigrams, the texts they occur in; a rule's candidates are the texts
in all lists of one alternative. Only candidates meet the pattern itself. A rule without mandatory trigrams,
such as a run of hexadecimal digits, is matched against every text. All of it is built-in
expressions.
"""

from __future__ import annotations

import re._constants as sre
import re._parser
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.text import shelve

MOST_WAYS = 256  # alternatives a pattern may unfold into before parts of it count as gaps
WIDEST_CLASS = 8  # characters of a class that are unfolded
MOST_GRAMS = 3  # trigrams of an alternative that are looked up
GAP = None


@dataclass(frozen=True)
class Rule:
    """A match counts if its ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0


# Kinds, patterns and lengths that the results are defined by, in order.
BASE = [
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9+/_.=-]+)", 12, 2),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16,}", 16),  # runs of 16 or more are what is left of all runs
]
# Public forms of tokens, by who issues them.
VENDORS = {
    "age": "AGE-SECRET-KEY-1[A-Z0-9]{58}",
    "app platform": "do[opr]_v1_[a-f0-9]{64}",
    "atlassian": "ATATT3[A-Za-z0-9_=-]{50,}",
    "aws session": "ASIA[A-Z0-9]{16}",
    "bot api": "[0-9]{8,10}:AA[A-Za-z0-9_-]{33}",
    "contentful": "CFPAT-[A-Za-z0-9_-]{43}",
    "databricks": "dapi[0-9a-f]{32}",
    "docker": "dckr_pat_[A-Za-z0-9_-]{20,}",
    "doppler": r"dp\.pt\.[A-Za-z0-9]{40,}",
    "dynatrace": r"dt0c01\.[A-Z0-9]{24}\.[A-Z0-9]{64}",
    "easypost": "EZAK[A-Za-z0-9]{54}",
    "figma": "figd_[A-Za-z0-9_-]{40,}",
    "fly": "fo1_[A-Za-z0-9_-]{43}",
    "frame.io": "fio-u-[A-Za-z0-9_=-]{64}",
    "github fine-grained": "github_pat_[A-Za-z0-9_]{22,}",
    "gitlab": "glpat-[A-Za-z0-9_-]{20,}",
    "gitlab runner": "glrt-[A-Za-z0-9_-]{20,}",
    "google api": "AIza[A-Za-z0-9_-]{35,}",
    "google oauth": r"ya29\.[A-Za-z0-9_-]{20,}",
    "grafana": "glsa_[A-Za-z0-9_]{32,}",
    "grafana cloud": "glc_[A-Za-z0-9+/=]{32,}",
    "hugging face": "hf_[A-Za-z0-9]{30,}",
    "linear": "lin_api_[A-Za-z0-9]{32,}",
    "mailgun": "key-[0-9a-f]{32}",
    "mapbox": r"sk\.eyJ[A-Za-z0-9_-]{20,}\.[A-Za-z0-9_-]{20,}",
    "new relic": "NRAK-[A-Z0-9]{27}",
    "npm": "npm_[A-Za-z0-9]{36,}",
    "openai": "sk-proj-[A-Za-z0-9_-]{20,}",
    "planetscale": "pscale_tkn_[A-Za-z0-9_.=-]{32,}",
    "postman": "PMAK-[a-f0-9]{24}-[a-f0-9]{34}",
    "prefect": "pnu_[a-z0-9]{36}",
    "pulumi": "pul-[a-f0-9]{40}",
    "pypi": "pypi-[A-Za-z0-9_-]{50,}",
    "readme": "rdme_[a-z0-9]{70}",
    "rubygems": "rubygems_[a-f0-9]{48}",
    "sendgrid": r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}",
    "sentry": "sntrys_[A-Za-z0-9+/=_-]{40,}",
    "shippo": "shippo_live_[a-f0-9]{40}",
    "shopify": "shp(?:at|ca|pa|ss)_[A-Fa-f0-9]{32}",
    "slack webhook": r"hooks\.slack\.com/services/[A-Za-z0-9/]{20,}",
    "square": "sq0(?:atp|csp)-[A-Za-z0-9_-]{22,}",
    "stripe": "[rs]k_live_[A-Za-z0-9]{16,}",
    "supabase": "sbp_[a-f0-9]{40}",
    "terraform": r"\.atlasv1\.[A-Za-z0-9_=-]{60,}",
    "typeform": "tfp_[A-Za-z0-9_-]{44,}",
    "vault": r"hvs\.[A-Za-z0-9_-]{24,}",
}
# A key block goes to its END line, over at most 16 dashes of header fields in between; without
# an END line it goes as far as base64 lines do.
KEY_BLOCK = ("-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+){0,16}"
             r"-----END [A-Z ]*PRIVATE KEY-----|[A-Za-z0-9+/=\x0A\x0D]*)")
EXTRA = [
    Rule("hosting", "gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("private_key", KEY_BLOCK),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+", 24),
    Rule("vendor", "|".join(VENDORS.values())),
]


def _ways(parsed) -> list[tuple]:
    """Ways to match a parsed pattern, each a tuple of characters and gaps."""
    ways: list[tuple] = [()]
    for op, arg in parsed:
        if op is sre.LITERAL:
            more = [(chr(arg),)]
        elif op is sre.BRANCH:
            more = [w for branch in arg[1] for w in _ways(branch)]
        elif op is sre.SUBPATTERN:
            more = _ways(arg[3])
        elif op is sre.IN and len(arg) <= WIDEST_CLASS and all(o is sre.LITERAL for o, _ in arg):
            more = [(chr(c),) for _, c in arg]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, item = arg
            if (low, high) == (0, 1) and item[0][0] is sre.LITERAL:
                more = [(), *_ways(item)]
            elif low == 0:
                more = [(GAP,)]
            else:
                more = [w * (low if low < 4 else 1) + (() if low == high < 4 else (GAP,))
                        for w in _ways(item)]
        elif op is sre.AT:
            continue
        else:
            more = [(GAP,)]
        if len(ways) * len(more) > MOST_WAYS:
            more = [(GAP,)]
        ways = [a + b for a, b in product(ways, more)]
    return ways


def trigram_query(pattern: str, fold: bool = True) -> list[frozenset[str]] | None:
    """Alternatives of trigrams, one of which every match contains in full; None if a match may do
    without any. Folded ones are in lower case; others hold for patterns that tell cases apart."""
    found = set()
    for way in _ways(re._parser.parse(pattern)):
        runs = "".join("\0" if c is GAP else c.lower() if fold else c for c in way).split("\0")
        grams = frozenset(r[i:i + 3] for r in runs for i in range(len(r) - 2))
        if not grams:
            return None
        found.add(grams)
    # an alternative that asks for more than another one adds nothing
    return sorted((a for a in found if not any(b < a for b in found)), key=sorted)


def rarest(grams: frozenset[str], most: int = MOST_GRAMS) -> list[str]:
    """The trigrams of an alternative that are looked up: those with fewest small letters. All of them
    are mandatory, so fewer only make more candidates, but frequent ones fill the index for nothing."""
    return sorted(grams, key=lambda g: (sum(map(str.islower, g)), g))[:most]


def postings(docs: DataFrame, folded: Sequence[str], exact: Sequence[str]) -> DataFrame:
    """The inverted index, limited to the given trigrams: ``trigram``, ``_key`` (hash of a text).
    Folded trigrams are looked up in the lower-cased text; exact ones, listed with a leading ``=``,
    in the text as it is. Copies of a text share an entry. Two texts of one hash would share theirs
    too, which can only make more candidates."""
    texts = docs.filter("text is not null").select(
        F.xxhash64("text").alias("_key"), F.lower("text").alias("_low"), "text")

    def met(trigrams: Sequence[str], text: str) -> Column:
        listed = F.array(*[F.lit(t) for t in trigrams]).cast("array<string>")
        return F.filter(listed, lambda t: F.contains(F.col(text), t))

    found = F.concat(met(folded, "_low"),
                     F.transform(met(exact, "text"), lambda t: F.concat(F.lit("="), t)))
    return texts.select("_key", F.explode(found).alias("trigram")).distinct()


def candidates(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``_key`` and ``_rules``, the places of the rules whose pattern the text has to meet."""
    needs, folded, exact = [], set(), set()
    for k, rule in enumerate(rules):
        fold = "(?i" in rule.pattern
        for n, alt in enumerate(trigram_query(rule.pattern, fold) or ()):
            chosen = rarest(alt)
            (folded if fold else exact).update(chosen)
            needs += [(k, n, t if fold else f"={t}", len(chosen)) for t in chosen]
    if not needs:
        return docs.sparkSession.createDataFrame([], "_key long, _rules array<int>")
    query = docs.sparkSession.createDataFrame(needs, "rule int, way int, trigram string, size int")
    index = postings(docs, sorted(folded), sorted(exact))
    met = index.join(F.broadcast(query), "trigram").groupBy("_key", "rule", "way", "size").count()
    return met.filter("count = size").groupBy("_key").agg(
        F.collect_set("rule").alias("_rules"))


def _ends(lengths: Column) -> Column:
    """Running sums."""
    return F.aggregate(
        lengths, F.array().cast("array<int>"),
        lambda x, n: F.array_append(x, n + F.coalesce(F.try_element_at(x, F.lit(-1)), F.lit(0))))


def rule_spans(text: Column, rule: Rule, place: int, matches: Column, judged: Column) -> Column:
    """(start, place, end) of each counted match, in characters. Cutting a text at the matches
    leaves what lies between them, so running lengths of both give the places."""
    between = F.slice(F.split(text, rule.pattern), 1, F.size(matches))
    steps = F.zip_with(between, matches, lambda a, b: F.length(a) + F.length(b))
    spans = F.zip_with(
        F.arrays_zip(_ends(steps).alias("end"), judged.alias("judged")), matches,
        lambda e, m: F.struct(
            (e["end"] - F.length(m)).alias("start"), F.lit(place).alias("place"),
            e["end"].alias("end"), (F.length(e["judged"]) >= rule.least).alias("counts")))
    return F.transform(F.filter(spans, lambda s: s["counts"]), lambda s: F.struct(
        s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end")))


def secret_spans(docs: DataFrame, rules: Sequence[Rule] = (*BASE, *EXTRA)) -> DataFrame:
    """``docs`` with ``secrets``: (start, place, end) of every match of every rule, sorted; ``place``
    is the rule's in ``rules``, start and end count characters, end exclusive.

    Needs ``text``; a column named ``secrets`` is replaced, all others stay. Matches of one rule
    are leftmost and do not overlap; those of different rules may. Null and empty texts have an
    empty list. Every row has its own result; repeated rows, null ids and ties need no rule.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    rows, back = shelve(docs, ["text"], ["secrets"])
    keyed = rows.withColumn("_key", F.xxhash64("text"))
    marked = keyed.join(candidates(rows, rules), "_key", "left")
    text, none = F.coalesce(F.col("text"), F.lit("")), F.array().cast(
        "array<struct<start:int,place:int,end:int>>")
    matched, found = {}, []
    for place, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        wanted = text.rlike(rule.pattern)
        if query is not None:
            # without the default a text in no list would be null here and still be matched
            wanted = F.coalesce(F.array_contains("_rules", place), F.lit(False)) & wanted
        for group in {0, rule.group}:
            matched[f"_m{place}_{group}"] = F.when(
                wanted, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)))
        matches, judged = F.col(f"_m{place}_0"), F.col(f"_m{place}_{rule.group}")
        found.append(F.when(matches.isNotNull(), rule_spans(text, rule, place, matches, judged)))
    spans = F.array_sort(F.concat(*[F.coalesce(f, none) for f in found]))
    return back(marked.withColumns(matched).withColumn("secrets", spans))


def span_string(spans: Column, rules: Sequence[Rule]) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["place"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(place: int) -> Column:
    """Spans of one rule in ``secrets``."""
    return F.size(F.filter("secrets", lambda s: s["place"] == place)).cast("long")


def redact(docs: DataFrame, rules: Sequence[Rule] = (*BASE, *EXTRA), mark: str = "[secret]",
           ) -> DataFrame:
    """``docs`` whose texts have ``mark`` in place of every stretch of characters in a span. Rows
    without spans, null texts among them, stay as they are."""
    rows, back = shelve(docs, ["text"], [])
    found = secret_spans(rows, rules)
    text = F.col("text")

    def step(x: Column, s: Column) -> Column:
        fresh = s["start"] >= x["at"]
        return F.struct(
            F.greatest(x["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(x["out"], F.substr(
                text, x["at"] + 1, s["start"] - x["at"]), F.lit(mark))).otherwise(x["out"])
            .alias("out"))

    done = F.aggregate(
        "secrets", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda x: F.concat(x["out"], F.substr(text, x["at"] + 1)))
    return back(found.withColumn("text", F.when(F.size("secrets") > 0, done).otherwise(text)))


def _spans_sql(rule: Rule, place: int) -> str:
    q = rule.pattern.replace("'", "''")
    return f"""SELECT id, list_transform(list_filter(list_zip(m, g, p, range(1, len(m) + 1)),
      lambda z: length(z[2]) >= {rule.least}), lambda z: struct_pack(
      s := CAST(list_sum(list_transform(p[1:z[4]], lambda x: length(x)))
        + coalesce(list_sum(list_transform(m[1:z[4] - 1], lambda x: length(x))), 0) AS BIGINT),
      place := {place}, n := length(z[1]))) AS spans
    FROM (SELECT id, regexp_extract_all(text, '{q}') AS m,
      regexp_extract_all(text, '{q}', {rule.group}) AS g,
      regexp_split_to_array(text, '{q}') AS p FROM d WHERE regexp_matches(text, '{q}'))"""


_RULES = (*BASE, *EXTRA)
_KINDS = ", ".join(f"'{r.kind}'" for r in _RULES)
_JOINED = "coalesce(string_agg(([" + _KINDS + """])[place + 1] || ':' || s || ':' || (s + n), ','
      ORDER BY s, place)"""
_COUNTS = ", ".join(
    f"count(*) FILTER (place = {k}) AS n_{r.kind}" for k, r in enumerate(BASE))
ORACLE_SQL = f"""WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
found AS (SELECT id, unnest(spans, recursive := true) FROM (
  {" UNION ALL ".join(_spans_sql(r, k) for k, r in enumerate(_RULES))})),
per AS (
  SELECT d.id, doc_id, {_COUNTS},
    {_JOINED} FILTER (place < {len(BASE)}), '') AS base,
    {_JOINED} FILTER (place >= 0), '') AS spans
  FROM d LEFT JOIN found USING (id) GROUP BY ALL)
SELECT doc_id, n_assign, n_access, n_hex, sha256(base) AS base_sha256, spans FROM per"""
