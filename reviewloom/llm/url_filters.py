"""URL filters: host and path rules, then a weighted vocabulary searched by an Aho-Corasick machine.

A url that a rule fits gets the rule's verdict. Any other is searched for strict and soft terms,
all in one pass; a hit counts only if no letter or digit touches it. One strict term, or several
different soft ones, block the url.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.text import ascii_lower, shelve

# verdict, host, path
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
STRICT = ["porn", "xxx", "hentai", "camgirls", "warez", "keygen"]
SOFT = ["adult", "bet", "bonus", "casino", "dating", "free", "gambling", "jackpot", "loan",
        "nude", "pharmacy", "poker", "sexy", "torrent", "viagra"]
SOFT_HITS = 2


# Weighted vocabulary: term -> (weight anywhere in the url, weight in the host). A url of weight
# BLOCK_AT or more is blocked. Gambling and adult terms block alone in a host; elsewhere two must
# meet. Forms are listed one by one, as a letter or digit at a term's edge makes it another word.
# Contexts take weight off again.
BLOCK_AT = 10


def _forms(weights: tuple[int, int], terms: str) -> dict[str, tuple[int, int]]:
    return dict.fromkeys(terms.split(), weights)


VOCABULARY: dict[str, tuple[int, int]] = {
    **_forms((10, 10), "porn porno pornos pornography pornographic pornstar pornstars pornhub xxx "
             "hentai camgirl camgirls camsex sexcam sexcams milf milfs bdsm blowjob blowjobs "
             "gangbang gangbangs cumshot cumshots creampie warez keygen keygens serialz crackz"),
    **_forms((5, 10), "adult adults casino casinos kasino bet bets betting bettor bettors gambling "
             "gamble gambles gambler gamblers jackpot jackpots poker roulette blackjack baccarat "
             "slots bookmaker bookmakers bookie bookies sportsbook sportsbooks wager wagers "
             "nude nudes nudity naked sex sexy sexual escort escorts erotic erotica fetish fetishes "
             "stripper strippers striptease webcamgirl webcamgirls swinger swingers hookup hookups "
             "viagra cialis levitra"),
    **_forms((5, 5), "dating slot torrent torrents pharmacy loan loans payday bonus bonuses lotto "
             "lottery lotteries crack cracks cracked cracking"),
    **_forms((3, 3), "free win wins winner winners winning cam cams girls babes hot online"),
    **_forms((-10, -10), "education educational learning literacy school schools college university "
             "library museum health medicine medical hospital science research recovery addiction "
             "prevention biology"),
}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as (length, blocks, rule); of two equally long, the blocking one."""
    fits = [
        F.when((F.concat(F.lit("."), host).endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(len(h + p)).alias("length"), F.lit(v == "block").alias("blocks"),
                        F.lit(h + p).alias("rule")))
        for v, h, p in rules
    ]
    empty = F.lit(None).cast("struct<length:int,blocks:boolean,rule:string>")
    return F.greatest(empty, *fits) if fits else empty


def term_counter(strict: Sequence[str], soft: Sequence[str]):
    """Distinct strict and soft terms of a url as a column function."""
    terms = [(t, True) for t in dict.fromkeys(strict)] + [
        (t, False) for t in dict.fromkeys(soft) if t not in set(strict)]

    @F.pandas_udf("n_strict long, n_soft long")
    def count(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term, is_strict in terms:
            machine.add_word(term, (term, is_strict))
        if terms:
            machine.make_automaton()

        def hits(url: str) -> tuple[int, int]:
            found = set()
            for end, (term, is_strict) in machine.iter(url) if terms else ():
                before, after = end - len(term), end + 1
                if (before < 0 or not _joined(url[before])) and (
                        after == len(url) or not _joined(url[after])):
                    found.add((term, is_strict))
            n = sum(s for _, s in found)
            return n, len(found) - n

        for urls in series:
            yield pd.DataFrame([hits(u or "") for u in urls], columns=["n_strict", "n_soft"])

    return count


def _joined(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def url_filters(
    pages: DataFrame, *, rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``n_strict``, ``n_soft`` and ``verdict``.

    Needs ``url``; columns with one of the new names are replaced, all others stay. Rules and terms
    are parameters of the plan, so their lists should stay in the thousands. Rows are judged one by
    one: repeated rows and ids stay as they are. A null or empty url, or one without ``://``, has
    an empty host and path and fits no rule; its terms are still counted (none for null: allow).
    """
    new = ["host", "path", "rule", "n_strict", "n_soft", "verdict"]
    host, path = host_and_path(F.col("url"))
    rows, back = shelve(pages, ["url"], new)
    out = rows.withColumns({"host": host, "path": path}).withColumns({
        "_rule": fitting_rule(F.col("host"), F.col("path"), rules),
        "_terms": term_counter(strict, soft)(ascii_lower(F.coalesce(F.col("url"), F.lit("")))),
    })
    bad = (F.col("_terms.n_strict") > 0) | (F.col("_terms.n_soft") >= soft_hits)
    blocked = F.when(F.col("_rule").isNull(), bad).otherwise(F.col("_rule.blocks"))
    return back(out.withColumns({
        "rule": F.col("_rule.rule"), "n_strict": F.col("_terms.n_strict"),
        "n_soft": F.col("_terms.n_soft"),
        "verdict": F.when(blocked, "block").otherwise("allow"),
    }))


def term_weigher(vocabulary: Mapping[str, tuple[int, int]]):
    """Summed weights of the distinct terms of a host and a url as a column function."""
    terms = dict(vocabulary)

    @F.pandas_udf("long")
    def weigh(series: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term in terms:
            machine.add_word(term, term)
        if terms:
            machine.make_automaton()

        def found(text: str) -> set[str]:
            return {
                term for end, term in (machine.iter(text) if terms else ())
                if (end < len(term) or not _joined(text[end - len(term)]))
                and (end + 1 == len(text) or not _joined(text[end + 1]))}

        def weight(host: str, url: str) -> int:
            inside = found(host)
            return sum(terms[t][1] for t in inside) + sum(
                terms[t][0] for t in found(url) - inside)

        for hosts, urls in series:
            yield pd.Series([weight(h or "", u or "") for h, u in zip(hosts, urls, strict=True)],
                            dtype="int64")

    return weigh


def weighted_url_filters(
    pages: DataFrame, *, rules: Sequence[tuple[str, str, str]] = RULES,
    vocabulary: Mapping[str, tuple[int, int]] = VOCABULARY, block_at: int = BLOCK_AT,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``weight`` and ``verdict``: like
    ``url_filters``, but a url that no rule fits is blocked by the summed weight of its terms."""
    new = ["host", "path", "rule", "weight", "verdict"]
    host, path = host_and_path(F.col("url"))
    rows, back = shelve(pages, ["url"], new)
    out = rows.withColumns({"host": host, "path": path}).withColumns({
        "_rule": fitting_rule(F.col("host"), F.col("path"), rules),
        "weight": term_weigher(vocabulary)(
            F.col("host"), ascii_lower(F.coalesce(F.col("url"), F.lit("")))),
    })
    blocked = F.when(F.col("_rule").isNull(), F.col("weight") >= block_at).otherwise(
        F.col("_rule.blocks"))
    return back(out.withColumns({
        "rule": F.col("_rule.rule"),
        "verdict": F.when(blocked, "block").otherwise("allow"),
    }))


def _matches(term: str) -> str:
    return f"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"


def _lower_sql(x: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate({x}, '{upper}', '{upper.lower()}')"


_COUNT = " + ".join
_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
ORACLE_SQL = f"""WITH rules(v, h, p) AS (VALUES {_RULE_ROWS}),
cut AS (
  SELECT page_id, coalesce({_lower_sql('url')}, '') AS low,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, low, {_lower_sql("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
terms AS (
  SELECT page_id, low, host, path,
    {_COUNT(f'CAST({_matches(t)} AS BIGINT)' for t in STRICT)} AS n_strict,
    {_COUNT(f'CAST({_matches(t)} AS BIGINT)' for t in SOFT)} AS n_soft
  FROM parts),
fit AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM (SELECT DISTINCT host, path FROM parts)
  JOIN rules ON ends_with('.' || host, '.' || h) AND starts_with(path, p) GROUP BY ALL)
SELECT page_id, t.host, t.path, rule, n_strict, n_soft,
  CASE WHEN rule IS NOT NULL THEN v WHEN n_strict > 0 OR n_soft >= {SOFT_HITS} THEN 'block'
    ELSE 'allow' END AS verdict
FROM terms t LEFT JOIN fit f ON t.host = f.host AND t.path = f.path"""


def _in(text: str, term: str) -> str:
    return f"regexp_matches({text}, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"


_WEIGHTS = _COUNT(
    f"CASE WHEN {_in('host', t)} THEN {in_host} WHEN {_in('low', t)} THEN {anywhere} ELSE 0 END"
    for t, (anywhere, in_host) in VOCABULARY.items())
WEIGHTED_SQL = f"""WITH rules(v, h, p) AS (VALUES {_RULE_ROWS}),
cut AS (
  SELECT page_id, coalesce({_lower_sql('url')}, '') AS low,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, low, {_lower_sql("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
terms AS (SELECT page_id, host, path, CAST({_WEIGHTS} AS BIGINT) AS weight FROM parts),
fit AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM (SELECT DISTINCT host, path FROM parts)
  JOIN rules ON ends_with('.' || host, '.' || h) AND starts_with(path, p) GROUP BY ALL)
SELECT page_id, t.host, t.path, rule, weight,
  CASE WHEN rule IS NOT NULL THEN v WHEN weight >= {BLOCK_AT} THEN 'block' ELSE 'allow' END
    AS verdict
FROM terms t LEFT JOIN fit f ON t.host = f.host AND t.path = f.path"""
