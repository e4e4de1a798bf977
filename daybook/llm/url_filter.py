"""URL filtering by host and path rules and a weighted vocabulary.

Rules decide first: the longest rule that fits gives the verdict. A url that no rule fits is judged by
its terms, which an Aho-Corasick automaton finds in one pass. Terms have weights, and a url whose
different terms weigh `limit` or more is blocked: one term suffices if it weighs so much by itself
(strict), of lighter ones (soft) several different ones are needed. A term counts only if no ASCII letter
or digit touches it; a term that occurs twice, or inside a longer one that counts too, counts once for itself.

The vocabulary is a table of terms and weights, of any size that an executor can hold; `url_terms.csv` is
the one that the query uses. Terms are compared in lower case of A-Z and may be of any script.

Null urls and urls without "://" have an empty host and path, so no rule fits; their terms still
count (null: no terms, hence allowed). Repeated rows are judged alike, very long urls are read whole, and
empty tables give no rows. Columns other than key and url are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from importlib import resources

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import table

#: (verdict, host, path prefix); a rule fits its host and all subdomains.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
LIMIT = 2
#: More terms than this are refused, as every task holds an automaton over all of them.
MOST_TERMS = 2_000_000


def host_of(url: Column) -> Column:
    """What stands between the first "://" and the next "/", "?", "#" or the end, A-Z in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_match(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest fitting rule, null without one. For lists of some hundred rules."""
    out = None
    for verdict, rule_host, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(prefix)
        hit = F.struct(F.lit(rule_host + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def lowered(text: str) -> str:
    """A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().decode()


def checked(terms: Iterable[tuple[str | None, int | None]]) -> dict[str, int]:
    """Terms with their weights; null and empty ones are left out, of repeated ones the heaviest counts."""
    found: dict[str, int] = {}
    for term, weight in terms:
        if term and weight is not None and weight > 0:
            found[lowered(term)] = max(weight, found.get(lowered(term), 0))
    if len(found) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    return found


def vocabulary(table_: DataFrame) -> dict[str, int]:
    """The vocabulary in a table with the columns term and weight."""
    rows = table_.select("term", F.col("weight").cast("int")).filter("term IS NOT NULL").limit(2 * MOST_TERMS + 1)
    return checked(map(tuple, rows.collect()))


def own_vocabulary() -> dict[str, int]:
    lines = resources.files(__package__).joinpath("url_terms.csv").read_text("utf-8").splitlines()[1:]
    return checked((term, int(weight)) for term, weight in (line.split(",") for line in lines))


def term_hits(df: DataFrame, weights: Mapping[str, int], url: str = "url", limit: int = LIMIT) -> DataFrame:
    """Appends to df how many different strict and soft terms stand in the url, and what they weigh together."""
    added = ("strict_hits", "soft_hits", "weight")
    schema = StructType([*df.schema.fields, *(StructField(n, IntegerType()) for n in added)])
    shared = df.sparkSession.sparkContext.broadcast(dict(weights))  # at most MOST_TERMS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, weight in shared.value.items():
            automaton.add_word(term, (term, weight))
        if shared.value:
            automaton.make_automaton()
        for batch in batches:
            hits: tuple[list, list, list] = [], [], []
            for value in batch.column(url).to_pylist():
                text, found = lowered(value or ""), {}
                for end, (term, weight) in automaton.iter(text) if shared.value and text else ():
                    around = text[end - len(term)] if end >= len(term) else "", text[end + 1 : end + 2]
                    if not any(c.isascii() and c.isalnum() for c in around):
                        found[term] = weight
                strict = sum(w >= limit for w in found.values())
                for column, n in zip(hits, (strict, len(found) - strict, sum(found.values()))):
                    column.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(h, pa.int32()) for h in hits)], names=[*batch.schema.names, *added])

    return df.mapInArrow(count, schema)


def judge_urls(pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, weights: Mapping[str, int] | None = None, limit: int = LIMIT) -> DataFrame:
    """key, url, host, path, rule, strict_hits, soft_hits, weight and verdict ("allow" or "block") of every row."""
    judged = term_hits(pages.select(F.col(key).alias(key), F.col(url).alias("url")), own_vocabulary() if weights is None else weights, "url", limit)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    own = F.when(F.col("weight") >= limit, "block").otherwise("allow")
    return (
        judged.withColumns({"host": host, "path": path})
        .withColumn("hit", rule_match(F.col("host"), F.col("path"), rules))
        .select(key, "url", "host", "path", F.col("hit.rule").alias("rule"), "strict_hits", "soft_hits", "weight", F.coalesce("hit.verdict", own).alias("verdict"))
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).drop("url", "weight")


def oracle() -> str:
    """The same judgement in SQL: rules as an ordered CASE, terms as bounded patterns."""
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r))
    fits = {r: f"(host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')" for r in ordered}
    rule = " ".join(f"WHEN {fits[r]} THEN '{r[1]}{r[2]}'" for r in ordered)
    verdict = " ".join(f"WHEN {fits[r]} THEN '{r[0]}'" for r in ordered)
    weights = own_vocabulary()
    kinds = [t for t, w in weights.items() if w >= LIMIT], [t for t, w in weights.items() if w < LIMIT]
    if any(w not in (1, LIMIT) for w in weights.values()):
        raise ValueError("the SQL counts soft terms as one each")
    strict, soft = (" + ".join(f"CAST(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INTEGER)" for t in terms) for terms in kinds)
    return f"""
        WITH cut AS (
            SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
                   translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        hits AS (SELECT *, CAST({strict} AS INTEGER) AS strict_hits, CAST({soft} AS INTEGER) AS soft_hits FROM cut)
        SELECT page_id, host, path, CASE {rule} END AS rule, strict_hits, soft_hits,
               CASE {verdict} WHEN strict_hits > 0 OR soft_hits >= {LIMIT} THEN 'block' ELSE 'allow' END AS verdict
        FROM hits"""
