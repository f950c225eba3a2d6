"""Building the dataset: stratified split, quotas, variations, chat examples, budgets."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import mutate
from ..functions.kinds import struct
from ..functions.rendering import pretty_json
from ..functions.text import after_marker, without_prompt
from ..functions.tokens import approximate, of_chat
from ..sources import records, registry, scratch, sinks
from ..sources.tables import in_small_batches
from .order import numbered

SPLITS = ("train", "validation", "test")


def draw(key: Column, seed: int) -> Column:
    """A pseudo-random text for a row, the same wherever it is computed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


#: So many classes at most are ranked in one task; beyond, by ranges as all rows are.
FEW_CLASSES = 10_000


def apportioned(classes: DataFrame, count: str, total: Column, seed: int, into: str, few: bool = False) -> DataFrame:
    """classes(class, ``count``, ...) with ``into``: each class's part of ``total`` (of the column one_n, the sum of the counts).

    A class has the whole part of its share, and the classes with the largest remainders one more each until the total is
    used up; ties go by a draw. Whole numbers throughout, so the parts add up to the total and depend on nothing else.
    """
    share = F.col(count) * F.col("total")
    first = classes.withColumn("total", total).withColumns({"whole": F.when(F.col("one_n") > 0, F.floor(share / F.col("one_n"))).otherwise(0).cast("long")})
    first = first.withColumn("rest", F.col(count) * F.col("total") - F.col("whole") * F.col("one_n"))
    tie = draw(F.coalesce(F.col("class").cast("string"), F.lit("")), seed)
    if few:
        every = Window.partitionBy()
        placed = first.withColumns({"place": F.row_number().over(Window.orderBy(F.desc("rest"), tie, "class")) - 1, "given": F.sum("whole").over(every)})
    else:
        placed = numbered(first, F.col("rest"), tie, F.col("class"), descending=True).select("row.*", "place").join(F.broadcast(first.agg(F.sum("whole").alias("given"))))  # one row
    part = F.col("whole") + F.when(F.col("place") < F.col("total") - F.col("given"), 1).otherwise(0)
    return placed.select(*classes.columns, part.cast("long").alias(into))


def stratified_split(rows: DataFrame, key: str, stratum: str, ratios: tuple[float, float] = (0.8, 0.1), seed: int = 42, least: int = 2) -> DataFrame:
    """rows with ``split``: floor(n * ratio) rows of all are train, half of the others (for ratios of 0.8 and 0.1; rounded down) validation, the rest test.

    Both numbers are shared out over the classes by largest remainders (``apportioned``), so the totals hold whatever the sizes
    of the classes; in each class rows go in the order of a draw. Sizes are exact, the split is disjoint and exhaustive;
    rows with a null key come first and null is a class of its own. A class of fewer than ``least`` rows is an error when
    the split is read. Ranks within a large class are not computed in one task: rows are ranked
    within a range of draws, and the counts of the ranges before are added.
    """
    # The row is one column from here on, so its names can't clash.
    drawn = rows.select(F.struct("*").alias("row"), F.col(stratum).alias("class"), F.col(key).alias("key"), draw(F.col(key), seed).alias("draw"))
    ranged = drawn.withColumn("range", F.coalesce(F.conv(F.left("draw", F.lit(2)), 16, 10).cast("int"), F.lit(-1)))
    counts = ranged.groupBy("class", "range").agg(F.count(F.lit(1)).alias("c"))
    by_class = Window.partitionBy("class")
    before = counts.select(
        F.col("class").alias("of_class"), F.col("range").alias("of_range"),
        F.coalesce(F.sum("c").over(by_class.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    sizes = scratch.kept(counts.groupBy("class").agg(F.sum("c").alias("c")), "classes")
    one = sizes.agg(F.sum("c").alias("one_n"), F.min("c").alias("one_least"))  # one row
    few = sizes.count() <= FEW_CLASSES
    train = apportioned(sizes.join(F.broadcast(one)), "c", F.floor(F.col("one_n") * ratios[0]).cast("long"), seed, "train", few)
    left = train.withColumn("c", F.col("c") - F.col("train")).drop("one_n")
    left = left.join(F.broadcast(left.agg(F.sum("c").alias("one_n"))))
    of_rest = ratios[1] / (1 - ratios[0]) if ratios[0] < 1 else 0.0
    quotas = apportioned(left, "c", F.floor(F.round(F.col("one_n") * of_rest, 6)).cast("long"), seed + 1, "validation", few)
    quotas = quotas.select(F.col("class").alias("quota_class"), "train", "validation", "one_least")
    ranked = ranged.withColumn("rank", F.row_number().over(Window.partitionBy("class", "range").orderBy("draw", "key")))
    joined = ranked.join(before, F.col("class").eqNullSafe(F.col("of_class")) & (F.col("range") == F.col("of_range"))).join(quotas, F.col("class").eqNullSafe(F.col("quota_class")))
    rank = F.col("rank") + F.col("before")
    split = F.when(rank <= F.col("train"), SPLITS[0]).when(rank <= F.col("train") + F.col("validation"), SPLITS[1]).otherwise(SPLITS[2])
    small = F.raise_error(F.concat(F.lit(f"a class has fewer than {least} rows: "), F.col("one_least").cast("string")))
    return joined.select("row.*", F.when(F.col("one_least") < least, small).otherwise(split).alias("split"))


def small_classes(rows: DataFrame, stratum: str, least: int = 2) -> DataFrame:
    """Classes too small to split."""
    return rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < least)


def split_table(rows: DataFrame, stratum: str) -> DataFrame:
    """Counts by class and split, null where there is none, and in total."""
    return rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("total"), *[F.nullif(F.count_if(F.col("split") == s), F.lit(0)).alias(s) for s in SPLITS])


def with_quota(rows: DataFrame, key: str, target: int) -> DataFrame:
    """Each row once as the original (ordinal 0, null variation_id) and as many variations as brings the total to the target.

    (target - n) is shared evenly; the first rows by key get one more until the
    rest is used up. variation_id counts variations over all rows, by key. At
    or above the target there are no variations. A column of rows that is called ordinal or variation_id is an error.
    """
    if clash := {"ordinal", "variation_id"} & set(rows.columns):
        raise ValueError(f"columns clash: {sorted(clash)}")
    placed = numbered(rows, F.col(key))  # the row is one column, so its names can't clash with those used here
    missing = F.greatest(F.lit(target) - F.col("n"), F.lit(0)).cast("long")
    each, extra = F.floor(missing / F.col("n")), missing % F.col("n")
    first = F.col("place") * each + F.least(F.col("place"), extra)
    count = each + F.when(F.col("place") < extra, 1).otherwise(0)
    out = placed.select("row", first.cast("long").alias("first"), F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long"))).alias("ordinal"))
    return out.select("row.*", "ordinal", F.when(F.col("ordinal") > 0, F.col("first") + F.col("ordinal") - 1).alias("variation_id"))


def variations(rows: DataFrame, key: str, html: str = "example_html", seed: int = 42, profile: str = "standard", metadata: str = "metadata") -> DataFrame:
    """Rows of ``with_quota`` with their html varied, and ``metadata`` (null for originals): variation_id, augmentations (as the gates chose), applied.

    A column of rows that is called as ``metadata`` is an error.
    """
    if metadata in rows.columns:
        raise ValueError(f"columns clash: {metadata}")
    in_small_batches(rows.sparkSession)

    # Names go from Python as one text: Arrow takes lists of texts one by one.
    @F.pandas_udf(struct("html string, augmentations string, applied string"))
    def vary(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, keys, ids in batches:
            made = []
            for t, k, v in zip(texts, keys, ids, strict=True):
                page, *names = (t, (), ()) if pd.isna(v) else mutate.vary(t or "", seed, k, int(v), profile)
                made.append((page, *map(" ".join, names)))
            yield pd.DataFrame(made, columns=["html", "augmentations", "applied"])

    made = rows.select(F.struct("*").alias("row"), vary.asNondeterministic()(F.col(html), F.col(key).cast("string"), F.col("variation_id")).alias("varied"))
    names = [F.filter(F.split(F.col(f"varied.{c}"), " "), lambda x: x != "").alias(c) for c in ("augmentations", "applied")]
    meta = F.when(F.col("row.variation_id").isNotNull(), F.struct("row.variation_id", *names))
    return made.select(*[F.col("varied.html").alias(c) if c == html else F.col("row")[c].alias(c) for c in rows.columns], meta.alias(metadata))


def variation_grid(rows: DataFrame, key: str, per_base: int = 100) -> DataFrame:
    """Each row ``per_base`` times with base_id and variation_id from 0, the original; null ids for the variation step there.

    Rows are dealt before they multiply: one file of pages would else be one task of ``per_base`` times as many variations.
    """
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    grid = rows.select("*", F.col(key).alias("base_id"), F.explode(F.sequence(F.lit(0), F.lit(per_base - 1))).alias("ordinal"))
    return grid.withColumn("variation_id", F.when(F.col("ordinal") > 0, F.col("ordinal").cast("long")))


def chat_examples(rows: DataFrame, prompts: DataFrame, html: str = "example_html", answer: str = "expected_json") -> DataFrame:
    """rows(type, html, answer) with messages array<struct<role, content>>; the answer (JSON) is rendered with an indent of 2; a type without a prompt is an error."""
    joined = rows.withColumn("rendered_answer", pretty_json.asNondeterministic()(F.col(answer))).join(F.broadcast(prompts), "type", "left")  # a few rows by construction
    known = F.when(F.col("prompt").isNull(), F.raise_error(F.concat(F.lit("unknown type: "), F.coalesce("type", F.lit("null"))))).otherwise(F.col("prompt"))
    user = F.concat(F.lit(registry.INSTRUCTION + "\n\n" + registry.HTML_MARKER), html, F.lit("\n\n"), known)
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return joined.withColumn("messages", F.array(turn("user", user), turn("assistant", F.col("rendered_answer")))).drop("rendered_answer")


def within_budget(rows: DataFrame, limit: int = registry.MAX_TOKENS, count=approximate) -> DataFrame:
    """rows(messages) with n_tokens, those over the limit dropped."""
    return rows.withColumn("n_tokens", of_chat(F.col("messages"), count)).filter(F.col("n_tokens") <= limit)


def budget_tally(rows: DataFrame, limit: int = registry.MAX_TOKENS, trained: int = registry.TRAIN_TOKENS, count=approximate) -> DataFrame:
    """n, kept and dropped (over the limit) of rows(messages), and over_trained: those kept that training would still cut."""
    n = rows.select(of_chat(F.col("messages"), count).alias("n_tokens"))
    kept = F.col("n_tokens") <= limit
    return n.agg(F.count(F.lit(1)).alias("n"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"), F.count_if(kept & (F.col("n_tokens") > trained)).alias("over_trained"))


def within_tokens(rows: DataFrame, text: str, least: int, most: int, count=approximate) -> DataFrame:
    """Rows whose text has from ``least`` to ``most`` tokens, both inclusive; null texts go."""
    return rows.filter(count(F.col(text)).between(least, most))


def first_rows(rows: DataFrame, by: str, limit: int) -> DataFrame:
    """The first rows by a key that tells rows apart: the same ones on any cluster, without a full sort."""
    return rows.orderBy(by).limit(limit)


def convert(spark, source: str, target: str, limit: int = registry.MAX_TOKENS) -> None:
    """A file of golden lines to a folder of chat lines: rendered, cut at the budget. A malformed line or an unknown type is an error; records that lack a key stay out."""
    golden = records.json_lines(spark, source).withColumn("file", F.lit(None).cast("string"))
    rows = records.valid(golden).select("type", "example_html", "expected_json")
    kept = within_budget(chat_examples(rows, registry.prompts(spark)), limit)
    sinks.write_lines(kept, sinks.chat_line(F.col("messages")), target)


def from_chat(rows: DataFrame, prompts: DataFrame) -> DataFrame:
    """rows(type, messages) with html as the marker cuts it, html without the prompt, and the answer."""
    cut = rows.join(F.broadcast(prompts), "type", "left").withColumn("html_and_prompt", after_marker(F.get("messages", F.lit(0))["content"]))
    return cut.withColumns({"html": without_prompt(F.col("html_and_prompt"), F.col("prompt")), "answer": F.get("messages", F.lit(1))["content"]})


def one_text(messages: Column, start: str = "<|im_start|>", end: str = "<|im_end|>") -> Column:
    """Messages as one text, each between marks."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit(start), m["role"], F.lit("\n"), m["content"], F.lit(end + "\n"))), "")


def few_of_each_host(rows: DataFrame, host: str, key: str, limit: int = 2) -> DataFrame:
    """At most ``limit`` rows of a host, by a draw. The smallest draws are kept before rows of a host meet."""
    picked = rows.select(F.struct("*").alias("row"), F.col(host).alias("host"), F.col(key).alias("key"), F.md5(F.col(key).cast("binary")).alias("draw"))
    salted = Window.partitionBy("host", F.left("draw", F.lit(2))).orderBy("draw", "key")
    near = picked.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= limit)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy("draw", "key"))).filter(F.col("rank") <= limit).select("row.*")
