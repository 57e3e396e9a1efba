"""DuckDB SQL of the queries on repeated passages, resampling and the Merkle manifest."""

from __future__ import annotations

import string

#: CTE of the 256 remainders of CRC-32, from its polynomial.
CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS remainders FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS UBIGINT), list_transform(range(8), lambda k: CAST(k AS UBIGINT))),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END) AS c
    FROM range(256) r(i)))"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a column, beside ``crc_table``."""
    byte = f"CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS UBIGINT)"
    bytes_ = f"list_transform(range(strlen({text})), lambda i: {byte})"
    step = "xor(c >> 8, remainders[CAST(xor(c, b) % 256 AS INT) + 1])"
    whole = "CAST(4294967295 AS UBIGINT)"
    return f"xor(list_reduce(list_prepend({whole}, {bytes_}), lambda c, b: {step}), {whole})"


_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _words(table: str, key: str) -> str:
    return rf"""SELECT {key}, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table}"""


RESAMPLING_SQL = f"""
WITH {CRC_TABLE}, docs AS ({_words("documents", "doc_id")}
), items AS ({_words("benchmark", "item_id")}
), known AS (
  SELECT word, CAST({crc32_sql("word")} % 10000 AS INT) AS bucket
  FROM (SELECT unnest(w) AS word FROM docs UNION SELECT unnest(w) FROM items), crc_table
), corpus AS (SELECT bucket, count(*) AS s FROM (SELECT unnest(w) AS word FROM docs) JOIN known USING (word) GROUP BY bucket
), target AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(w) AS word FROM items) JOIN known USING (word) GROUP BY bucket
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM corpus) + 10000)::DOUBLE
    / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM target) + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM corpus FULL JOIN target USING (bucket)
), weights AS (
  SELECT doc_id, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight
  FROM (SELECT doc_id, unnest(w) AS word FROM docs) JOIN known USING (word) JOIN gain USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS UBIGINT)::DOUBLE + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""

#: Levels that the SQL unrolls: sources of up to 3 ** 9 rows.
_LEVELS = 9


def _levels(name: str, leaves: str) -> str:
    """CTEs name_0 (tree, i, h) to name_9: the nodes of every level; a lone node stays as it is."""
    steps = [f"{name}_0 AS ({leaves})"]
    for k in range(_LEVELS):
        steps.append(
            f"{name}_{k + 1} AS (SELECT tree, i // 3 AS i, CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h"
            f" FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}_{k}) GROUP BY tree, i // 3)"
        )
    return ", ".join(steps)


def _folds(name: str, start: str) -> str:
    """CTEs name_fold_0 (key, tree, i, proof, x) to name_fold_9: the path of every leaf, the siblings' digests added to ``proof``."""
    steps = [f"{name}_fold_0 AS ({start})"]
    for k in range(_LEVELS):
        around = (
            f"coalesce((SELECT string_agg(s.h, '' ORDER BY s.i) FROM {name}_{k} s"
            f" WHERE s.tree = f.tree AND s.i // 3 = f.i // 3 AND s.i {{}} f.i), '')"
        )
        steps.append(
            f"{name}_sides_{k} AS (SELECT f.*, {around.format('<')} AS before, {around.format('>')} AS after,"
            f" (SELECT count(*) FROM {name}_{k} s WHERE s.tree = f.tree) AS n FROM {name}_fold_{k} f)"
        )
        steps.append(
            f"{name}_fold_{k + 1} AS (SELECT key, tree, i // 3 AS i, proof || before || after AS proof,"
            f" CASE WHEN n = 1 THEN x ELSE sha256(before || x || after) END AS x FROM {name}_sides_{k})"
        )
    return ", ".join(steps)


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    coded = [f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
    return f"sha256({' || '.join(coded)})"


MERKLE_SQL = f"""
WITH {CRC_TABLE}, leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS h,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS changed
  FROM documents, crc_table
), placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, h) - 1 AS i FROM leaves
), {_levels("low", "SELECT tree, i, h FROM placed")}
, sources AS (SELECT tree AS source, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, h FROM low_{_LEVELS}
), {_levels("up", "SELECT '' AS tree, i, h FROM sources")}
, {_folds("low", "SELECT doc_id AS key, tree, i, '' AS proof, changed AS x FROM placed")}
, {_folds("up", f"SELECT key, '' AS tree, s.i, proof, x FROM low_fold_{_LEVELS} f JOIN sources s ON s.source = f.tree")}
SELECT doc_id, placed.h AS leaf, sources.h AS subroot, up_{_LEVELS}.h AS root, sha256(proof) AS proof_sha256, x AS folded_root,
  x = up_{_LEVELS}.h AS verified
FROM placed JOIN sources ON sources.source = placed.tree JOIN up_fold_{_LEVELS} f ON f.key = placed.doc_id, up_{_LEVELS}
"""

#: Strings of 100 bytes as digits; a byte goes if one that covers it starts earlier somewhere.
REPEATS_SQL = """
WITH texts AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(coalesce(text, '')) AS digits FROM documents
), starts AS (
  SELECT doc_id, i, md5(substr(digits, 2 * i + 1, 200)) AS string
  FROM (SELECT doc_id, digits, unnest(range(n - 99)) AS i FROM texts WHERE n >= 100)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY string ORDER BY doc_id, i) AS k FROM starts) WHERE k > 1
), bytes AS (
  SELECT doc_id, i, substr(digits, 2 * i + 1, 2) AS digit FROM (SELECT doc_id, digits, unnest(range(n)) AS i FROM texts)
), covered AS (
  SELECT doc_id, i, digit, count(again.i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM bytes LEFT JOIN again USING (doc_id, i)
), edges AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM covered
), cut AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
    coalesce(string_agg(digit, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM edges GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""
