"""Training data: pseudo-labelled rows, prompts with answers, contrastive triplets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.defaults import EXAMPLE_COLUMNS, NEGATIVE_TOKEN, POSITIVE_TOKEN, PSEUDO_FRACTION, SEED
from ruleweave.functions.text import build_prompt, clean_urls, digest, label_to_token, pick_example
from ruleweave.operators.indexing import build_pool_index, pick_partners
from ruleweave.operators.sampling import head_n, sample_fraction, sample_n, stratified_sample
from ruleweave.operators.sets import distinct_at_home, distinct_texts, union_with_missing
from ruleweave.operators.stages import HOME, PLACE, discard, materialize, skew_join, store_in_place

Watch = Callable[[str, DataFrame], DataFrame]


def unwatched(stage: str, df: DataFrame) -> DataFrame:
    return df


# Stored comments lie by blocks that share their examples. Pages of 8 MB let the codec see more of them at once.
CODEC = "zstd"
DENSE = {"parquet.compression.codec.zstd.level": "6", "parquet.page.size": str(8 << 20)}

PSEUDO_COLUMNS = ["rule", "subreddit", "body", "positive_example", "negative_example", "rule_violation"]


def unpivot_examples(
    comments: DataFrame, *, id_col: str = "row_id", seed: int = SEED, keep: list[str] | None = None
) -> DataFrame:
    """Turn each row into four labelled rows, one per worked example.

    The example becomes the body and its sibling the example of the same side; the example of the other side is
    drawn. Positive examples break the rule, so they are labelled 1. With ``keep`` these columns follow, and ``_slot``, which
    tells the four rows apart.
    """

    def slice_of(side: str, i: int) -> Column:
        other = "negative" if side == "positive" else "positive"
        drawn = pick_example(f"{other}_example_1", f"{other}_example_2", f"pseudo-{side}-{i}", id_col, seed=seed)
        sibling = F.col(f"{side}_example_{3 - i}")
        return F.struct(
            F.col(f"{side}_example_{i}").alias("body"),
            (sibling if side == "positive" else drawn).alias("positive_example"),
            (drawn if side == "positive" else sibling).alias("negative_example"),
            F.lit(1 if side == "positive" else 0).alias("rule_violation"),
        )

    slices = F.array(*[slice_of(side, i) for side in ("positive", "negative") for i in (1, 2)])
    if keep is None:
        return comments.select("rule", "subreddit", F.explode(slices).alias("_slice")).select(
            "rule", "subreddit", "_slice.*"
        )
    return comments.select("rule", "subreddit", *keep, F.posexplode(slices).alias("_slot", "_slice")).select(
        "rule", "subreddit", "_slice.*", *keep, "_slot"
    )


def pseudo_training_set(
    comments: DataFrame,
    *,
    frac: float = PSEUDO_FRACTION,
    id_col: str = "row_id",
    seed: int = SEED,
    watch: Watch = unwatched,
    homes: int | None = None,
) -> DataFrame:
    """Labelled rows made of the worked examples of a stratified sample of the comments.

    ``watch`` is given the stages "sampled" and "pseudo", for instance to count their rows (``StageCounts``). With ``homes`` the
    sample is stored in so many (``store_in_place``), and of its rows only digests and places are shuffled.
    """
    sampled = watch("sampled", stratified_sample(comments, "rule", frac, id_col=id_col, tag="pseudo", seed=seed))
    if homes is None:
        return watch("pseudo", unpivot_examples(sampled, id_col=id_col, seed=seed).select(*PSEUDO_COLUMNS).dropDuplicates())
    sampled = store_in_place(sampled, homes, codec=CODEC, options=DENSE)
    rows = unpivot_examples(sampled, id_col=id_col, seed=seed, keep=[HOME, PLACE])
    return watch("pseudo", distinct_at_home(rows.select(*PSEUDO_COLUMNS, HOME, PLACE, "_slot"), [PLACE, "_slot"], homes))


def with_drawn_examples(df: DataFrame, *, id_col: str = "row_id", seed: int = SEED) -> DataFrame:
    """Fill ``positive_example`` and ``negative_example`` by a coin where they are still missing."""
    for side in ("positive", "negative"):
        name = f"{side}_example"
        drawn = pick_example(f"{name}_1", f"{name}_2", f"prompt-{side}", id_col, seed=seed)
        df = df.withColumn(name, F.coalesce(F.col(name), drawn) if name in df.columns else drawn)
    return df


def prompt_dataset(
    train: DataFrame,
    comments: DataFrame | None = None,
    *,
    frac: float = PSEUDO_FRACTION,
    sample_size: int | None = None,
    positive_token: str = POSITIVE_TOKEN,
    negative_token: str = NEGATIVE_TOKEN,
    seed: int = SEED,
    watch: Watch = unwatched,
    homes: int | None = None,
) -> DataFrame:
    """(prompt, completion) from the train rows and, if ``comments`` is given, its pseudo-labelled rows.

    ``sample_size`` keeps the first rows: train rows by id, then pseudo rows, which have none, in a random order.
    ``watch`` is given the stages of ``pseudo_training_set``, "train" and "total"; not with ``sample_size``. So is ``homes``.
    """
    completion = label_to_token("rule_violation", positive_token=positive_token, negative_token=negative_token)

    def prompts(rows: DataFrame) -> DataFrame:
        return with_drawn_examples(rows, seed=seed).select(
            "row_id", build_prompt().alias("prompt"), completion.alias("completion")
        )

    if comments is None:
        return head_n(prompts(train), sample_size).select("prompt", "completion")
    if not sample_size:
        pseudo = pseudo_training_set(comments, frac=frac, seed=seed, watch=watch, homes=homes)
        rows = watch("total", union_with_missing(watch("train", train), pseudo))
        return prompts(rows).select("prompt", "completion")
    pseudo = pseudo_training_set(comments, frac=frac, seed=seed)
    first = head_n(prompts(train), sample_size).select("prompt", "completion")
    left = sample_size - train.count()
    if left <= 0:
        return first
    # Pseudo rows have no id, so their order is a draw on their content.
    more = prompts(pseudo.withColumn("row_id", F.lit(None).cast("long")).select("*", *_no_examples()))
    keyed = more.withColumn("_content", digest(F.concat("prompt", "completion")))
    return first.unionAll(sample_n(keyed, left, id_col="_content", tag="head", seed=seed).select("prompt", "completion"))


def _no_examples() -> list[Column]:
    return [F.lit(None).cast("string").alias(c) for c in EXAMPLE_COLUMNS]


def triplet_rows(
    anchors: DataFrame,
    train: DataFrame,
    *,
    sample_size: int | None = None,
    fraction: float = 1.0,
    draws_per_anchor: int = 1,
    clean_pool: bool = False,
    seed: int = SEED,
    homes: int | None = None,
) -> DataFrame:
    """(row_id, draw_no, anchor, positive, negative), one row per anchor and draw.

    The positive has the anchor's rule and another community, the negative another rule; both are uniform picks
    from the train rows. An anchor without a candidate on either side is left out. With ``homes``, the number of homes of the
    anchors' table (``store_in_place``), the picked texts go to the anchors, which stay where they lie.
    """
    if sample_size is not None:
        anchors = sample_n(anchors, sample_size, tag="anchors", seed=seed)
    if fraction < 1.0:
        anchors = sample_fraction(anchors, fraction, tag="anchor-share", seed=seed)
    index = build_pool_index(train, seed=seed)
    at = [HOME] if homes else []
    repeated = anchors.select("row_id", "rule", "subreddit", *at).withColumn(
        "draw_no", F.explode(F.sequence(F.lit(0), F.lit(draws_per_anchor - 1)))
    )
    ids = ["row_id", "draw_no"]
    picks = pick_partners(repeated, index, positive=True, negative=True, id_cols=ids, keep=at, seed=seed)
    # Narrow rows, stored so that the planner's freedom at home does not reach the joins that number the pool.
    picks = materialize(picks) if homes else picks

    text = clean_urls("body") if clean_pool else F.col("body")
    pool_texts = train.select(F.col("row_id").alias("pool_id"), text.alias("_text"))

    def role(name: str) -> Column:
        return F.first(F.when(F.col("role") == name, F.struct("_text")), ignorenulls=True)["_text"].alias(name)

    # A small pool is picked from by many anchors, so its rows may be hot.
    texts = skew_join(picks, pool_texts, ["pool_id"], "inner", spread_by="row_id")
    # Spread by the home or the leading id alone: that serves both the grouping and the join with the anchors' own texts.
    texts = texts.repartition(homes, HOME) if homes else texts.repartition("row_id")
    pairs = texts.groupBy(*at, *ids).agg(role("positive"), role("negative"))
    return anchors.select("row_id", *at, clean_urls("body").alias("anchor")).join(pairs, [*at, "row_id"]).select(
        *ids, "anchor", "positive", "negative"
    )


def triplet_dataset(anchors: DataFrame, train: DataFrame, **options) -> DataFrame:
    """(anchor, positive, negative); see :func:`triplet_rows` for the options. Duplicates are kept."""
    return triplet_rows(anchors, train, **options).select("anchor", "positive", "negative")


def training_tables(comments: DataFrame, watch: Watch = unwatched, **options) -> dict[str, DataFrame]:
    """``prompts``, ``triplets`` and ``texts`` made of one table of labelled and unlabelled comments, each stored.

    The comments are stored first, so their source is read once. ``watch`` is given each stage on the way: loaded, train, sampled,
    pseudo, total, triplets and distinct_texts. Options go to ``triplet_rows``.
    """
    homes = int(comments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    labelled = F.col("rule_violation").isNotNull()
    drawn = ["positive_example", "negative_example"]
    plain = [c for c in comments.columns if c not in EXAMPLE_COLUMNS]
    # Train rows need their drawn examples only. In one column, those that neighbours share lie near each other.
    examples = F.when(labelled, F.array(*drawn)).otherwise(F.array(*EXAMPLE_COLUMNS)).alias("_examples")
    loaded = with_drawn_examples(watch("loaded", comments)).select(*plain, examples)
    stored = store_in_place(loaded, homes, codec=CODEC, options=DENSE)

    def unpacked(names: list[str]) -> dict[str, Column]:
        return {name: F.col("_examples")[i].alias(name) for i, name in enumerate(names)}

    kept = {c: F.col(f"`{c}`") for c in plain}
    train = stored.filter(labelled).select(*(kept | unpacked(drawn)).values(), *_no_examples())
    test = stored.filter(~labelled)
    whole = kept | unpacked(EXAMPLE_COLUMNS)
    unlabelled = test.select(*[whole[c] for c in comments.columns if c != "rule_violation"])

    def table(df: DataFrame, **how) -> DataFrame:
        return materialize(df, codec=CODEC, options=DENSE, **how)

    tables = {
        "prompts": table(prompt_dataset(train, unlabelled, watch=watch, homes=homes), at_home=True),
        "triplets": table(watch("triplets", triplet_rows(test, train, homes=homes, **options)), at_home=True),
        "texts": table(watch("distinct_texts", distinct_texts(stored, ["body"], homes=homes)), at_home=True),
    }
    discard(stored)
    return tables
