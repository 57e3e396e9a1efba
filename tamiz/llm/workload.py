"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm import (
    decontamination,
    license_scan,
    merkle,
    neighbours,
    packing,
    quality_classifier,
    quality_rules,
    repeats,
    resampling,
    sharding,
    simhash,
    token_counts,
    toxicity,
)
from tamiz.llm.common import frozen, held_out, load, words
from tamiz.llm.oracles import MERKLE_SQL, REPEATS_SQL, RESAMPLING_SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def _judged(scored: DataFrame, cutoff: float) -> DataFrame:
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted")
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_classifier.fit(docs, load(spark, sf_dir, "labels"), ["n_chars"])
    return _judged(quality_classifier.with_score(docs, model, ["n_chars"]), 0.7)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(load(spark, sf_dir, "documents"), license_scan.known_texts(spark))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"), "n_tokens")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = quality_rules.with_statistics(load(spark, sf_dir, "documents")).select("doc_id", "statistics")
    counted = frozen(counted, "quality-statistics")
    table = quality_rules.cutoffs(counted, load(spark, sf_dir, "labels"))
    judged = quality_rules.with_verdict(counted, table)
    counts = [f"statistics.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select(
        "doc_id", *counts, quality_rules.base_failed(F.col("statistics")).alias("base_failed"), "kept"
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(load(spark, sf_dir, "documents"), 24)
    text = F.coalesce("record.text", F.lit(""))
    return sharded.select(
        "record.doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    done = repeats.remove_repeats(docs)
    return done.select(
        "record.doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    network = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return _judged(toxicity.with_score(docs, network), 0.3)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    marked = frozen(simhash.with_fingerprint(docs).select("doc_id", "fingerprint"), "simhash-fingerprints")
    linked = simhash.near_duplicates(marked)
    return linked.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, load(spark, sf_dir, "benchmark").select("text"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(load(spark, sf_dir, "embeddings"), divisor=20, k=20)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    unbroken = F.translate("text", "\n", "")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    leaf = merkle.leaf(*fields, F.col("text"))
    leaves = docs.select(
        "source",
        "doc_id",
        F.unhex(leaf).alias("digest"),
        F.unhex(F.when(tampered, merkle.leaf(*fields, unbroken)).otherwise(leaf)).alias("changed"),
    )
    return merkle.proofs(leaves)


LLM_QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_license_scan": op3_license_scan,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_sharding": op6_sharding,
    "op7_suffix_array": op7_suffix_array,
    "op8_toxicity": op8_toxicity,
    "op9_decontamination": op9_decontamination,
    "op10_simhash": op10_simhash,
    "op11_resampling": op11_resampling,
    "op12_neighbours": op12_neighbours,
    "op13_merkle": op13_merkle,
}

_LENGTH_CLASS = " + ".join(f"CAST(n_words >= {low} AS INT)" for low in quality_rules.STRATA)
_VALUES = {
    "symbols": "n_symbols / NULLIF(n_words, 0)",
    "capitals": "n_capitals / NULLIF(word_chars, 0)",
    "dup_lines": "n_dup_lines / NULLIF(n_lines, 0)",
    "repeats": "n_repeat_words / NULLIF(n_words, 0)",
}
_TESTS = (len(quality_rules.STRATA) + 1) * len(quality_rules.RULES) * len(quality_rules.CUTOFFS)

RULES_SQL = rf"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT r, i, list_slice(w, i, i + 7) AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM split WHERE len(w) >= 8)
), found AS (
  SELECT r, count(DISTINCT j) AS n FROM (
    SELECT r, unnest(range(i, i + 8)) AS j
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM windows) WHERE c > 1
  ) GROUP BY r
), counted AS (
  SELECT doc_id, r, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(found.n, 0) AS n_repeat_words
  FROM split LEFT JOIN found USING (r)
), classed AS (
  SELECT *, {_LENGTH_CLASS} AS stratum,
    {", ".join(f"coalesce({v}, 0) AS v_{k}" for k, v in _VALUES.items())}
  FROM counted
), good AS (
  SELECT doc_id FROM labels WHERE quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), candidates AS (
  SELECT rule, cut FROM (VALUES {", ".join(f"('{r}')" for r in quality_rules.RULES)}) AS a(rule),
    (VALUES {", ".join(f"({c})" for c in quality_rules.CUTOFFS)}) AS b(cut)
), tested AS (
  SELECT stratum, rule, cut, count(*) AS n,
    count(*) FILTER (CASE rule {" ".join(f"WHEN '{k}' THEN v_{k}" for k in _VALUES)} END > cut) AS k
  FROM classed JOIN good USING (doc_id), candidates GROUP BY stratum, rule, cut
), chosen AS (
  SELECT stratum, rule, min(cut) AS cut FROM tested
  WHERE k < n * {quality_rules.ALPHA / len(quality_rules.RULES)}
    AND list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
        + i * ln({quality_rules.ALPHA / len(quality_rules.RULES)})
        + (n - i) * ln({1 - quality_rules.ALPHA / len(quality_rules.RULES)})))) <= {quality_rules.DELTA / _TESTS}
  GROUP BY stratum, rule
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    EXISTS (SELECT 1 FROM chosen c WHERE c.stratum = classed.stratum AND
      CASE c.rule {" ".join(f"WHEN '{k}' THEN v_{k}" for k in _VALUES)} END > c.cut) AS over
  FROM classed
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT over AS kept
FROM judged
"""

def _shingles_sql(table: str, key: str) -> str:
    return rf"""
  SELECT DISTINCT {key}, list_slice(w, i, i + 4) AS s FROM (
    SELECT {key}, w, unnest(range(1, len(w) - 3)) AS i FROM (
      SELECT {key}, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '),
        lambda x: x <> '') AS w FROM {table}
    ) WHERE len(w) >= 5)"""


CONTAINED_SQL = f"""
WITH items AS ({_shingles_sql("benchmark", "item_id")}
), docs AS ({_shingles_sql("documents", "doc_id")}
), sizes AS (SELECT item_id, count(*) AS shingles FROM items GROUP BY item_id
), found AS (SELECT doc_id, item_id, count(*) AS shared FROM docs JOIN items USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, shingles FROM found JOIN sizes USING (item_id) WHERE 10 * shared >= 8 * shingles
"""

def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    plain = f"""regexp_replace(array_to_string(list_filter(string_split(lower(coalesce({text}, '')), chr(10)),
      lambda x: NOT regexp_matches(x, {_quoted(license_scan.COPYRIGHT_LINE)})), ' '), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"""
    spaced = f"' ' || replace(trim({plain}), ' ', '  ') || ' '"
    for spelling, common in license_scan.SPELLINGS.items():
        one, other = (x.replace(" ", "  ") for x in (spelling, common))
        spaced = f"replace({spaced}, ' {one} ', ' {other} ')"
    return f"trim(replace({spaced}, '  ', ' '))"


LICENSE_SQL = f"""
WITH known AS (
  SELECT DISTINCT license, {_canonical_sql("text")} AS c
  FROM (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in license_scan.KNOWN)}) AS k(license, text)
), units AS (
  SELECT doc_id, 0 AS line, text AS unit FROM documents
  UNION ALL
  SELECT doc_id, i AS line, lines[i] AS unit FROM (
    SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
), canon AS (SELECT doc_id, line, {_canonical_sql("unit")} AS c FROM units)
SELECT doc_id, CASE WHEN line = 0 THEN 'text' ELSE 'line' END AS scope, line, license
FROM canon JOIN known USING (c) WHERE c <> ''
"""

LLM_ORACLES: dict[str, str] = {
    "op3_license_scan": LICENSE_SQL,
    "op5_quality_rules": RULES_SQL,
    "op7_suffix_array": REPEATS_SQL,
    "op9_decontamination": CONTAINED_SQL,
    "op11_resampling": RESAMPLING_SQL,
    "op13_merkle": MERKLE_SQL,
}
