"""Groups of spellings that share a folded key, and nearly equal spellings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.text import name_key, trimmed
from tamiz.operators.distinct import distinct_counts_by
from tamiz.operators.skew import join_per_key


#: Spellings that the list of a group holds at most; `spelling_forms` has all of them as rows.
FORMS = 1_000


def _forms(df: DataFrame, value: Column, keep: Column | None, key, blank_apart: bool) -> DataFrame:
    """(nombre, n, clave): the spellings with their rows and key.

    Spellings without a letter or digit have the key ""; they have nothing in
    common but that, so they are left out if `blank_apart`.
    """
    rows = df.select(value.alias("nombre"), (F.lit(True) if keep is None else keep).alias("_keep"))
    forms = rows.where("_keep").groupBy("nombre").agg(F.count("*").alias("n"))
    # Not nullable, or joins would repeat the key in a null filter.
    forms = forms.withColumn("clave", F.coalesce(key(F.col("nombre")), F.lit("")))
    return forms.where("clave <> ''") if blank_apart else forms


def _several(forms: DataFrame) -> DataFrame:
    return (
        forms.groupBy("clave")
        .agg(F.count("*").alias("escrituras"), F.sum("n").alias("registros"))
        .where("escrituras > 1")
    )


def spelling_groups(
    df: DataFrame,
    value: Column,
    distinct: dict[str, Column],
    keep: Column | None = None,
    key=name_key,
    most: int = FORMS,
    blank_apart: bool = True,
) -> DataFrame:
    """Keys written in more than one way.

    Per key: `escrituras` spellings, one distinct count per entry of
    `distinct`, `registros` rows and `formas`, the first `most` spellings in
    order. Keys are counted first; the spellings of those with several
    are ranked, and each task passes on `most` of a key, so a key may have any
    number of them. The key is computed once per distinct spelling.
    """
    forms = _forms(df, value, keep, key, blank_apart)
    several = _several(forms)
    within = forms.join(several.select("clave"), "clave", "left_semi")
    rank = F.row_number().over(Window.partitionBy("clave").orderBy("nombre"))
    first = within.select("clave", "nombre").withColumn("_rank", rank).where(F.col("_rank") <= most)
    listed = first.groupBy("clave").agg(F.array_sort(F.collect_list("nombre")).alias("formas"))
    groups = several.join(listed, "clave")
    if distinct:
        rows = df.select(
            value.alias("nombre"),
            *[c.alias(n) for n, c in distinct.items()],
            (F.lit(True) if keep is None else keep).alias("_keep"),
        ).where("_keep")
        counts = distinct_counts_by(
            rows,
            {"clave": F.coalesce(key(F.col("nombre")), F.lit(""))},
            {n: F.col(n) for n in distinct},
        )
        # One row per key on both sides.
        groups = groups.join(counts, "clave", "left").fillna(0, subset=list(distinct))
    return groups.select("clave", "escrituras", *distinct, "registros", "formas")


def spelling_forms(
    df: DataFrame, value: Column, keep: Column | None = None, key=name_key, blank_apart: bool = True
) -> DataFrame:
    """The spellings themselves: (clave, nombre, registros, escrituras) rows.

    The same groups as `spelling_groups` without a list per key: all spellings, however many a key has.
    """
    forms = _forms(df, value, keep, key, blank_apart)
    several = _several(forms).select("clave", "escrituras")
    return join_per_key(forms, several, ["clave"], "escrituras").select(
        "clave", "nombre", F.col("n").alias("registros"), "escrituras"
    )


def label_by_count(df: DataFrame, column: str, one: str, several: str) -> DataFrame:
    """Adds `categoria` from a count and sorts by it."""
    labelled = df.withColumn("categoria", F.when(F.col(column) == 1, one).otherwise(several))
    return labelled.orderBy("categoria", F.desc("escrituras"), "clave")


def preferred_spelling(
    df: DataFrame, value: Column, jurisdiction: Column, keep: Column
) -> DataFrame:
    """Most frequent spelling per (key, jurisdiction), with the number of forms.

    Ties go to the form with more accents kept, then to the last in order.
    """
    counted = (
        df.select(
            trimmed(value).alias("nombre"),
            trimmed(jurisdiction).alias("jurisdiccion"),
            keep.alias("_keep"),
        )
        .where("_keep")
        .groupBy("nombre", "jurisdiccion")
        .agg(F.count("*").alias("n"))
        .withColumn("clave", name_key(F.col("nombre")))
    )
    best = F.max(F.struct("n", F.octet_length("nombre").alias("bytes"), "nombre"))
    return counted.groupBy("clave", "jurisdiccion").agg(
        best["nombre"].alias("nombre_preferido"),
        F.count("*").alias("escrituras"),
        F.sum("n").alias("registros"),
    )


def truncated_names(
    df: DataFrame, value: Column, jurisdiction: Column, keep: Column | None = None, least_words: int = 2
) -> DataFrame:
    """(jurisdiccion, corta, completa, registros_corta, registros_completa): keys whose words begin
    another key of the jurisdiction.

    Each distinct key gives its beginnings of `least_words` words or more, one
    row a word, and meets the keys that are one: no two keys are compared that
    have no beginning in common. Rows without a jurisdiction are not compared.
    """
    names = (
        df.select(
            trimmed(jurisdiction).alias("jurisdiccion"),
            name_key(trimmed(value)).alias("clave"),
            (F.lit(True) if keep is None else keep).alias("_keep"),
        )
        .where("_keep AND jurisdiccion <> '' AND clave <> ''")
        .groupBy("jurisdiccion", "clave")
        .agg(F.count("*").alias("registros"))
    )
    words = F.split("clave", " ")
    ends = F.sequence(F.lit(least_words), F.size(words) - 1)
    begins = F.transform(ends, lambda n: F.array_join(F.slice(words, 1, n), " "))
    longer = names.where(F.size(words) > least_words).select(
        "jurisdiccion",
        F.explode_outer(begins).alias("corta"),
        F.col("clave").alias("completa"),
        F.col("registros").alias("registros_completa"),
    )
    shorter = names.select(
        "jurisdiccion", F.col("clave").alias("corta"), F.col("registros").alias("registros_corta")
    )
    return longer.join(shorter, ["jurisdiccion", "corta"]).select(
        "jurisdiccion", "corta", "completa", "registros_corta", "registros_completa"
    )


def near_pairs(
    df: DataFrame, value: Column, block: Column | None = None, max_distance: int = 1
) -> DataFrame:
    """All pairs of distinct folded names within an edit distance, per block.

    Two texts within distance d share a text that is left after at most d
    deletions from each. Joining on those shortened texts replaces comparing
    all pairs of a block: the texts that share one shortened form differ from
    it by d insertions, so their number depends on name length and alphabet
    and not on the rows. Row copies are merged before the join.
    """
    where = F.lit("") if block is None else trimmed(block)
    names = (
        df.select(where.alias("bloque"), name_key(trimmed(value)).alias("clave"))
        .where("clave <> ''")
        .groupBy("bloque", "clave")
        .agg(F.count("*").alias("registros"))
    )

    def shorten(texts: Column) -> Column:
        def drop_one(text: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))),
                lambda i: F.concat(
                    F.substring(text, F.lit(1), i - 1),
                    F.substring(text, i + 1, F.length(text)),
                ),
            )

        return F.array_distinct(F.concat(texts, F.flatten(F.transform(texts, drop_one))))

    reduced = F.array("clave")
    for _ in range(max_distance):
        reduced = shorten(reduced)
    # Their hashes travel: a text of L characters has L forms of L characters each.
    hashed = F.array_distinct(F.transform(reduced, lambda form: F.xxhash64(form)))
    shapes = names.select("bloque", "clave", "registros", F.explode_outer(hashed).alias("_shape"))
    left = shapes.select(
        "bloque", "_shape", F.col("clave").alias("clave_a"), F.col("registros").alias("registros_a")
    )
    right = shapes.select(
        "bloque", "_shape", F.col("clave").alias("clave_b"), F.col("registros").alias("registros_b")
    )
    return (
        left.join(right, ["bloque", "_shape"])
        .where("clave_a < clave_b")
        .drop("_shape")
        .distinct()
        .withColumn("distancia", F.levenshtein("clave_a", "clave_b"))
        .where(F.col("distancia") <= max_distance)
        .select("bloque", "clave_a", "clave_b", "registros_a", "registros_b", "distancia")
    )
