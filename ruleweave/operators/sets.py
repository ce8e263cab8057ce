"""Predicates, distincts, unions and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ruleweave.defaults import EXAMPLE_COLUMNS
from ruleweave.functions.text import clean_urls, digest, str_or_nan
from ruleweave.operators.stages import HOME, PLACE, skew_join


def filter_not_missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def filter_rule(df: DataFrame, rule: str, *, rule_col: str = "rule") -> DataFrame:
    return df.filter(F.col(rule_col) == rule)


def filter_known_text(
    df: DataFrame, vectors: DataFrame, *, text_col: str, keep: list[str] | None = None, spread_by: str | None = None
) -> DataFrame:
    """Rows whose text has a vector. ``vectors`` has a ``text_key`` column that holds a text's digest once.

    The semi-join moves the digest and the columns to ``keep`` (by default all), so name the row keys alone where the text is not
    wanted. A text with very many copies is compared where its rows lie. ``spread_by``: by default the first column kept.
    """
    keep = keep or df.columns
    keyed = df.select(digest(text_col).alias("_text_key"), *[F.col(f"`{c}`") for c in keep])
    known = vectors.select(F.col("text_key").alias("_text_key"))
    return skew_join(keyed, known, ["_text_key"], "left_semi", spread_by=spread_by or keep[0]).drop("_text_key")


def clean_text_columns(df: DataFrame, columns: list[str]) -> Column:
    """All texts of a row, URLs cleaned, as an array without missing values."""
    cleaned = F.array(*[clean_urls(F.col(c).cast("string")) for c in columns])
    return F.filter(cleaned, lambda t: t.isNotNull())


def distinct_texts(df: DataFrame, columns: list[str] | None = None, *, homes: int | None = None) -> DataFrame:
    """Distinct texts of the given columns, by default of all that get a vector: body, rule and examples.

    With ``homes``, the number of homes of a table of ``store_in_place``, a text stays where it first occurs and only digests and
    places are shuffled.
    """
    columns = columns or ["body", "rule", *EXAMPLE_COLUMNS]
    texts = clean_text_columns(df, columns)
    if homes is None:
        return df.select(F.explode(texts).alias("text")).distinct()
    return distinct_at_home(df.select(HOME, PLACE, F.posexplode(texts).alias("_slot", "text")), [PLACE, "_slot"], homes)


def row_digest(columns: list[str]) -> Column:
    cells = [F.col(f"`{c}`").cast("string") for c in columns]
    # Lengths keep the cells apart.
    marked = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in cells]
    return F.unhex(F.sha2(F.concat(*marked).cast("binary"), 256))


def distinct_at_home(df: DataFrame, place: list[str], homes: int) -> DataFrame:
    """Distinct rows of a table of ``store_in_place``, not counting ``HOME`` and ``place``, which are left out.

    ``place`` tells the rows of a home apart. Of equal rows that with the least home and place is kept, where it lies.
    """
    at = [HOME, *place]
    columns = [c for c in df.columns if c not in at]
    owners = df.select(row_digest(columns).alias("_digest"), F.struct(*at).alias("_o")).groupBy("_digest").agg(F.min("_o").alias("_o"))
    kept = owners.select("_o.*").repartition(homes, HOME)
    return df.join(kept.hint("shuffle_hash"), at, "left_semi").select(*columns)


def distinct_rows(df: DataFrame, *, group: list[str], place: list[str]) -> DataFrame:
    """Distinct rows, not counting the columns ``group`` and ``place``, which are left out; only digests of rows are shuffled.

    ``df`` is dealt by ``group``, whose columns are never missing, and ``place`` tells the rows of a group apart. Of equal rows that
    with the least group and place is kept. Groups must be small: each gathers the places it keeps.
    """
    columns = [c for c in df.columns if c not in (*group, *place)]
    owners = df.select(row_digest(columns).alias("_digest"), F.struct(*group, *place).alias("_o")).groupBy("_digest").agg(F.min("_o").alias("_o"))
    kept = owners.groupBy(*[F.col(f"_o.{c}").alias(c) for c in group]).agg(
        F.collect_list(F.struct(*[F.col(f"_o.{c}").alias(c) for c in place])).alias("_kept")
    )
    return df.join(kept, group).filter(F.array_contains("_kept", F.struct(*place))).select(*columns)


def distinct_rules(df: DataFrame, *, rule_col: str = "rule") -> DataFrame:
    return df.select(rule_col).distinct()


def side_rows(comments: DataFrame) -> DataFrame:
    """(rule_key, violating, text), one row per worked example, URLs cleaned.

    Positive examples are the ones that break the rule. Rows without a rule belong to no set.
    """
    sides = [
        F.struct(F.lit(c.startswith("positive")).alias("violating"), F.col(c).alias("text")) for c in EXAMPLE_COLUMNS
    ]
    return (
        comments.filter(F.col("rule").isNotNull())
        .select(clean_urls(str_or_nan("rule")).alias("rule_key"), F.explode(F.array(*sides)).alias("e"))
        .filter(F.col("e.text").isNotNull())
        .select("rule_key", "e.violating", clean_urls("e.text").alias("text"))
    )


def side_texts(comments: DataFrame) -> DataFrame:
    """Distinct (rule_key, violating, text) over the worked examples."""
    return side_rows(comments).distinct()


def union_with_missing(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both; a column that one side lacks is missing there."""
    return first.unionByName(second, allowMissingColumns=True)


class StageCounts:
    """Row counts of the stages of a flow, taken by the tasks that run it.

    Call it with a name and a frame and go on with the frame it returns; once the actions that run the frames are done,
    ``frame`` holds the counts. Nothing is run for the counts alone. A stage that runs again after an executor is lost is counted
    again, so put a stage that must be exact right before a sink. A frame is run by one action; one that no action has run
    by then has no row.
    """

    def __init__(self):
        self._watched: dict[str, Observation] = {}
        self._done: dict[str, int] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        if name in self._watched or name in self._done:
            raise ValueError(f"stage {name!r} is counted already")
        self._watched[name] = Observation(f"rows-{name}")
        return df.observe(self._watched[name], F.count(F.lit(1)).alias("n_rows"))

    def add(self, name: str, n_rows: int) -> None:
        """A count that follows from others."""
        self._done[name] = n_rows

    def __getitem__(self, name: str) -> int:
        return self._done[name] if name in self._done else self._watched[name].get["n_rows"]

    def frame(self, spark: SparkSession) -> DataFrame:
        """(stage, n_rows), in the order in which the stages were named."""
        rows = [(name, self[name]) for name in (*self._watched, *self._done)]
        return spark.createDataFrame(rows, "stage string, n_rows long")


def stage_counts(**stages: DataFrame) -> DataFrame:
    """One row (stage, n_rows) per named frame, each of them run to be counted; see ``StageCounts`` for counts on the way."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows")
        for name, df in stages.items()
    ]
    result = counted[0]
    for more in counted[1:]:
        result = result.union(more)
    return result


def union_slices(*slices: DataFrame) -> DataFrame:
    """All rows of frames with the same columns, by name."""
    whole = slices[0]
    for part in slices[1:]:
        whole = whole.unionByName(part)
    return whole
