"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm import (
    bpe,
    fingerprints,
    license_scan,
    manifest,
    neighbours,
    packing,
    periodic_runs,
    quality,
    secret_scan,
    simhash,
    token_files,
    url_lists,
    warc,
)
from shopmart.llm import oracle_sql as oracle_sql_texts
from shopmart.llm.common import documents, new_folder, ship, stored

Query = Callable[[SparkSession, str], DataFrame]

IDS_FILE = "byte_bpe_50k.json"
RANKS_FILE = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    warc.register(spark)
    folder = new_folder(spark, "warc")
    records = warc.to_records(table(spark, sf_dir, "pages"), min_bytes=0)
    records.write.format("warc").mode("append").option("compression", "gzip").save(folder)
    found = spark.read.format("warc").option("payload", "digest").load(folder)
    return found.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to_id")).alias("refers_to"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    labels = table(spark, sf_dir, "labels")
    found = quality.classify(documents(spark, sf_dir), labels)
    return found.select(
        "doc_id",
        "lang",
        F.round("perplexity", 6).alias("perplexity"),
        F.round("threshold", 6).alias("threshold"),
        "is_kept",
    )


def dictionary() -> frozenset[str]:
    return secret_scan.read_dictionary(public_tokenizers.path(RANKS_FILE))


def secret_findings(docs: DataFrame) -> DataFrame:
    """All candidates in ``docs``, stored."""
    return stored(secret_scan.findings(docs, dictionary()), "secret-candidates")


def secret_forest(found: DataFrame) -> secret_scan.Forest:
    """A forest trained on findings, which a rule labels, and reference findings."""
    rows = found.select("features", "label", "candidate", "start")
    given = secret_scan.reference_findings(dictionary())
    reference = found.sparkSession.createDataFrame(given, rows.schema)
    return secret_scan.train(rows, reference=reference)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = secret_findings(documents(spark, sf_dir))
    judged = secret_scan.judge(found, secret_forest(found))
    return judged.select(
        "doc_id",
        "start",
        F.char_length("candidate").cast("long").alias("length"),
        F.sha2(F.col("candidate").cast("binary"), 256).alias("candidate_sha256"),
        F.round("score", 6).alias("score"),
        "is_secret",
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    path = public_tokenizers.path(IDS_FILE)
    return packing.pack(documents(spark, sf_dir), path, with_ids=False).drop("ids")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = fingerprints.edited(documents(spark, sf_dir))
    both = edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        fingerprints.minhash(F.col("edited")).alias("edited_fingerprint"),
        "next_fingerprint",
    )
    own, other, after = (
        F.col(c) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint")
    )
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.fingerprint_text(own).alias("fingerprint"),
        fingerprints.fingerprint_text(other).alias("edited_fingerprint"),
        fingerprints.likeness(own, other).alias("near_edited"),
        fingerprints.likeness(own, after).alias("near_next"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = simhash.near_components(documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return neighbours.search(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


MINUTES = 525_600


def _minute(spread: int) -> Column:
    """A moment of 2024 that follows from the page's id, as pages have no time of fetch."""
    minute = F.pmod(F.col("page_id") * spread, F.lit(MINUTES))
    return F.timestamp_seconds(F.lit(1_704_067_200) + 60 * minute)


def captures_and_entries(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every page as a capture, and every page's report as a dated list entry: its host, the
    domain above that or the page itself goes on one of five lists, or off it."""
    captures = pages.select("page_id", "url", _minute(7919).alias("fetched_at"))
    above = url_lists.parents(url_lists.host(F.col("url")))
    n = F.octet_length("html")
    key = (
        F.when(n % 7 == 0, F.concat(F.lit("page:"), url_lists.page_key(F.col("url"))))
        .when(n % 2 == 0, F.concat(F.lit("domain:"), F.get(above, F.lit(0))))
        .otherwise(F.concat(F.lit("domain:"), F.get(above, F.size(above) - 1)))
    )
    entries = pages.select(
        F.concat(F.lit("list"), (F.length("url") % 5).cast("string")).alias("list"),
        key.alias("key"),
        _minute(104_729).alias("at"),
        (n % 3 != 0).alias("is_listed"),
    )
    return captures, entries


def op8_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures, entries = captures_and_entries(table(spark, sf_dir, "pages"))
    found = url_lists.filter_captures(captures, entries)
    return found.select(
        "page_id",
        F.unix_seconds("fetched_at").alias("fetched_s"),
        F.array_join("lists", ",").alias("lists"),
        "is_blocked",
    )


OP8_SQL = r"""
WITH p AS (
  SELECT page_id, url, octet_length(encode(html)) AS n,
         regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '\.$', '') AS host,
         regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path
  FROM pages
), q AS (
  SELECT *, string_split(host, '.') AS labels,
         1704067200 + 60 * ((page_id * 7919) % 525600) AS fetched,
         1704067200 + 60 * ((page_id * 104729) % 525600) AS reported
  FROM p
), r AS (
  SELECT *, list_transform(range(1, greatest(len(labels) - 1, 1) + 1),
                           lambda k: array_to_string(labels[k:], '.')) AS above
  FROM q
), entries AS (
  SELECT 'list' || (length(url) % 5) AS list,
         CASE WHEN n % 7 = 0 THEN 'page:' || host || path
              WHEN n % 2 = 0 THEN 'domain:' || above[1]
              ELSE 'domain:' || above[len(above)] END AS key,
         reported AS at, min(n % 3 <> 0) AS is_listed
  FROM r GROUP BY ALL
), asked AS (
  SELECT page_id, fetched, 'page:' || host || path AS key FROM r
  UNION SELECT page_id, fetched, 'domain:' || unnest(above) FROM r
), pairs AS (
  SELECT a.page_id, a.fetched, a.key, k.list
  FROM asked a JOIN (SELECT DISTINCT list, key FROM entries) k USING (key)
), found AS (
  SELECT DISTINCT c.page_id, c.list
  FROM pairs c ASOF JOIN entries e ON c.key = e.key AND c.list = e.list AND c.fetched >= e.at
  WHERE e.is_listed
)
SELECT r.page_id, r.fetched AS fetched_s,
       coalesce(string_agg(f.list, ',' ORDER BY f.list), '') AS lists, count(f.list) > 0 AS is_blocked
FROM r LEFT JOIN found f ON r.page_id = f.page_id
GROUP BY r.page_id, r.fetched
"""


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    path = public_tokenizers.path(IDS_FILE)
    folder = new_folder(spark, "token-files")
    token_files.write_tokens(documents(spark, sf_dir), folder, path)
    return token_files.read_tokens(spark, folder, with_ids=False).drop("ids")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    ranks = public_tokenizers.path(RANKS_FILE)
    return bpe.round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def crc32_of_id() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``documents`` (id and text) in whose tenth part, by a checksum of the id, the words from one on repeat
    those before them; other texts stay as they are."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g = F.floor(crc32_of_id() / 10)

    def edited(found: Column) -> Column:
        n = F.size(found).cast("long")
        a = F.pmod(g, n).cast("int")
        period = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        later = F.transform(
            F.sequence(F.lit(0), (n - a - 1).cast("int")),
            lambda k: F.get(found, a + F.pmod(k, period)),
        )
        whole = F.array_join(F.concat(F.slice(found, F.lit(1), a), later), " ")
        return F.when(n > 0, whole).otherwise(F.col("text"))

    chosen = F.pmod(crc32_of_id(), F.lit(10)) == 0
    text = F.when(chosen, fingerprints.bound(words, edited)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = periodic_runs.find_runs(with_planted_runs(documents(spark, sf_dir)))
    best = periodic_runs.strongest(F.col("runs"))
    found = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.transform(
            "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
        ).alias("lines"),
        "collapsed",
    )
    milli = F.floor(1000 * F.col("best.length") / F.col("best.period"))
    return found.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        milli.cast("long").alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(crc32_of_id(), F.lit(5)) == 0
    return manifest.verified_manifest(documents(spark, sf_dir), tampered)


def queries() -> dict[str, Query]:
    return {
        "op1_warc": op1_warc,
        "op2_quality": op2_quality,
        "op3_secrets": op3_secrets,
        "op4_packing": op4_packing,
        "op5_fingerprints": op5_fingerprints,
        "op6_simhash": op6_simhash,
        "op7_neighbours": op7_neighbours,
        "op8_url_lists": op8_url_lists,
        "op9_token_files": op9_token_files,
        "op10_bpe": op10_bpe,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_licenses": op12_licenses,
        "op13_manifest": op13_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_url_lists": OP8_SQL,
        "op12_licenses": oracle_sql_texts.licenses(
            license_scan.PHRASES,
            license_scan.TEMPLATES,
            license_scan.CONTAINMENT,
            license_scan.LEAST_STRIDE,
        ),
        "op13_manifest": oracle_sql_texts.manifest(),
    }
