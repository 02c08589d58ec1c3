"""Benchmark decontamination by templates.

Texts are brought to templates: capitalised words inside a sentence become ``<name>``, units after a
number ``<unit>``, numbers ``<num>``, everything else lower-case words. Windows of a template are joined
by hash with those of the benchmark's items, so a question with other names or numbers still meets its
item. Then the slots are checked: along one alignment of document and item, equal slots of the item must
hold equal values in the document, and different ones different values. Where they do not, the windows with
slots of that kind do not count, or only those with altered slots, if the item's own value stands in others
of the equal slots; windows without slots always count. An item is leaked by a document when enough of its
windows count.

Everything is a DataFrame expression. Windows leave the documents as hashes; only those that the
benchmark has are kept. The benchmark's windows are broadcast while they are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded, documents, stored

WINDOW = 8
#: Words of a window that must not be placeholders.
LEAST_WORDS = 4
#: The share of an item's windows that a document must have.
COVERAGE = 0.3

UNITS = (
    "mm", "cm", "km", "m", "mg", "kg", "g", "lb", "lbs", "oz", "ml", "l", "litres?", "liters?", "miles?", "feet", "foot",
    "ft", "inch(?:es)?", "yards?", "met(?:er|re)s?", "kilomet(?:er|re)s?", "grams?", "kilograms?", "pounds?", "tons?",
    "seconds?", "minutes?", "hours?", "days?", "weeks?", "months?", "years?", "mph", "dollars?", "euros?", "cents?", "percent",
)
NAME = r"\p{Lu}(?<=[\p{L}\p{N},;:)] \p{Lu})\p{Ll}+"
UNIT = r"(?i)(?<=\d)( ?)(?:" + "|".join(UNITS) + r")\b|(?<=\d) ?%|(?<=[$€£])(?=\d)"
NUMBER = r"[$€£]?\d(?:[\d.,]*\d)?"
#: What stands between the tokens of a template.
BETWEEN = r"[^\p{L}<>]+"


def _named(text: Column) -> Column:
    """The text with its names as placeholders, which are tokens of their own also inside a word
    ("YouTube"); what is written like a placeholder in the text itself is none."""
    return F.regexp_replace(_plain(text), NAME, " <name> ")


def _plain(text: Column) -> Column:
    return F.regexp_replace(text, "(?i)<(?=(?:name|unit|num)>)", "< ")


def template(text: Column) -> Column:
    """The tokens of a text's template."""
    united = F.regexp_replace(_named(text), UNIT, " <unit> ")
    numbered = F.regexp_replace(F.lower(united), NUMBER, " <num> ")
    return F.filter(F.split(numbered, BETWEEN), lambda t: t != "")


def windows(tokens: Column, window: int = WINDOW) -> Column:
    """A hash per window of the template, in order; none if it is shorter."""
    n = F.size(tokens) - window
    return F.when(n >= 0, F.transform(F.sequence(F.lit(1), n + 1), lambda i: F.xxhash64(F.slice(tokens, i, window))))


def _slots(text: Column) -> Column:
    """The values of a text's placeholders per kind, in order."""
    named = _named(text)
    united = F.regexp_replace(named, UNIT, " <unit> ")
    return F.struct(
        F.regexp_extract_all(_plain(text), F.lit(NAME), F.lit(0)).alias("name"),
        F.transform(F.regexp_extract_all(named, F.lit(UNIT), F.lit(0)), lambda u: F.lower(F.trim(u))).alias("unit"),
        F.transform(F.regexp_extract_all(F.lower(united), F.lit(NUMBER), F.lit(0)), lambda v: F.regexp_replace(v, "[$€£,]", "")).alias("num"),
    )


def _valued(rows: DataFrame, key: str) -> DataFrame:
    """One row per placeholder: key, its place among the tokens, kind and value. Rows come in by their
    templates; placeholders and values are numbered per text and kind, and joined by these numbers, so the work
    grows with the placeholders of a text and no row carries them all."""
    texts = rows.select(key, "text", F.xxhash64("text").alias("of")).distinct()
    each = texts.select(key, "of", F.posexplode(template(F.col("text"))).alias("place", "kind")).where("kind in ('<name>', '<unit>', '<num>')")
    order = Window.partitionBy(key, "of", "kind").orderBy("place")
    numbered = each.withColumn("nth", F.row_number().over(order))
    slots = texts.select(key, "of", _slots(F.col("text")).alias("slots"))
    of_kind = lambda k: F.transform(F.col(f"slots.{k}"), lambda v, i: F.struct(F.lit(f"<{k}>").alias("kind"), (i + 1).alias("nth"), v.alias("value")))
    values = slots.select(key, "of", F.explode(F.concat(*map(of_kind, ("name", "unit", "num")))).alias("v")).select(key, "of", "v.*")
    found = numbered.join(values, [key, "of", "kind", "nth"], "left")
    return found.select(key, "place", "kind", F.coalesce("value", F.lit("")).alias("value"))


def leaks(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item it leaks: doc_id, item_id, n_windows of the item, n_found, coverage,
    n_slots compared and n_same_values of them.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are ignored. Null or
    empty texts have no windows, and texts shorter than a window leak nothing; rows with a null id cannot
    be named and are left out. Repeated rows, and rows with one id, count as one. Items with the same
    template are all reported. Empty tables give no rows.
    """
    items = benchmark.where("item_id is not null").select("item_id", "text").distinct()
    of_item = items.select("item_id", template(F.col("text")).alias("tokens")).select("item_id", "tokens", F.posexplode(windows(F.col("tokens"), window)).alias("item_place", "hash"))
    literal = F.size(F.filter(F.slice("tokens", F.col("item_place") + 1, window), lambda t: ~t.isin("<name>", "<unit>", "<num>")))
    of_item = stored(of_item.where(literal >= min(LEAST_WORDS, window)).select("item_id", "item_place", "hash"), "item-windows")
    known = bounded(of_item)

    texts = docs.where("doc_id is not null").select("doc_id", template(F.col("text")).alias("tokens"))
    of_doc = texts.select("doc_id", F.posexplode(windows(F.col("tokens"), window)).alias("doc_place", "hash"))
    hits = stored(of_doc.join(known, "hash").select("doc_id", "item_id", "doc_place", "item_place"), "hits")
    sizes = of_item.groupBy("item_id").agg(F.countDistinct("item_place").alias("n_windows"))
    hits = hits.withColumn("shift", F.col("doc_place") - F.col("item_place"))
    able = hits.groupBy("doc_id", "item_id").agg(F.countDistinct("item_place").alias("most")).join(sizes, "item_id").where(F.col("most") >= coverage * F.col("n_windows"))
    hits = stored(hits.join(able.select("doc_id", "item_id", "n_windows"), ["doc_id", "item_id"]), "able")

    # the slots of the item, and what the document has in their places, along each alignment
    item_values = _valued(items, "item_id").withColumnsRenamed({"place": "slot", "kind": "item_kind", "value": "item_value"})
    places = hits.select("doc_id", "item_id", "shift", F.explode(F.sequence("item_place", F.col("item_place") + window - 1)).alias("slot")).distinct()
    asked = places.join(item_values, ["item_id", "slot"]).withColumn("place", F.col("slot") + F.col("shift"))
    ids = bounded(stored(asked.select("doc_id").distinct(), "leak-ids"))
    doc_values = _valued(docs.select("doc_id", "text").join(ids, "doc_id"), "doc_id").dropDuplicates(["doc_id", "place"])
    pairs = asked.join(doc_values, ["doc_id", "place"])
    # Equal slots with different values, one of them the item's own, are a copy with some altered: those are
    # spoiled. In any other conflict all slots of the kind are.
    alignment = ["doc_id", "item_id", "shift"]
    pairs = stored(pairs.select(*alignment, "slot", "kind", "item_value", "value"), "slot-pairs")
    once = pairs.groupBy(*alignment, "kind", "item_value", "value").agg(F.count("*").alias("n"))
    own = F.bool_or(F.col("item_value") == F.col("value"))
    groups = once.groupBy(*alignment, "kind", "item_value").agg(F.count("*").alias("values"), own.alias("own"))
    kinds = once.groupBy(*alignment, "kind").agg((F.count("*") > F.countDistinct("value")).alias("merged"))
    torn = groups.groupBy(*alignment, "kind").agg(F.bool_or((F.col("values") > 1) & ~F.col("own")).alias("torn"))
    faulty = kinds.join(torn, [*alignment, "kind"]).select(*alignment, "kind", (F.col("merged") | F.col("torn")).alias("faulty"))
    judged = pairs.join(faulty, [*alignment, "kind"]).join(groups.select(*alignment, "kind", "item_value", "values"), [*alignment, "kind", "item_value"])
    same = F.col("item_value") == F.col("value")
    judged = stored(judged.select(*alignment, "slot", same.alias("same"), (F.col("faulty") | ((F.col("values") > 1) & ~same)).alias("spoiled")), "judged-slots")
    # a window is sound unless it covers a spoiled slot
    spoiled = judged.where("spoiled").select(*alignment, F.explode(F.sequence(F.col("slot") - window + 1, F.col("slot"))).alias("item_place")).distinct()
    sound = hits.join(spoiled, [*alignment, "item_place"], "left_anti")
    compared = judged.where("not spoiled").groupBy(*alignment).agg(F.count("*").alias("n_slots"), F.count_if("same").alias("n_same"))
    by_shift = sound.select(*alignment, "n_windows").distinct().join(compared, alignment, "left")
    slots = by_shift.groupBy("doc_id", "item_id").agg(F.coalesce(F.sum("n_slots"), F.lit(0)).alias("n_slots"), F.coalesce(F.sum("n_same"), F.lit(0)).alias("n_same_values"))
    found = sound.groupBy("doc_id", "item_id", "n_windows").agg(F.countDistinct("item_place").alias("n_found"))
    share = F.col("n_found") / F.col("n_windows")
    leaked = found.where(F.col("n_found") >= coverage * F.col("n_windows")).withColumn("coverage", share)
    return leaked.join(slots, ["doc_id", "item_id"]).select("doc_id", "item_id", "n_windows", "n_found", "coverage", "n_slots", "n_same_values")


def op1_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
