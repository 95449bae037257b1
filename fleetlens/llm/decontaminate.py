"""Benchmark decontamination by template windows: DataFrame expressions only.

Method. Words are the runs of letters and digits; in scripts without spaces every letter is a word. A word becomes a typed placeholder if it starts with a digit (number), has a
capital (name) or is a unit of measure; other words stay. Windows of five such words are hashed and joined with those of the
benchmark, the five words being compared as well. Windows of placeholders alone carry no wording and are left out. A match of a
document and an item lies on a diagonal (the distance of their positions); on it, every slot value of the item must stand for one
value of the document, or the diagonal does not count. The same windows are also joined by their words with the case folded: such
a window is verbatim and needs no diagonal. An item is found in a document if the windows of the consistent diagonals and the
verbatim ones cover at least 0.8 of its windows. So a question with other numbers and names is found as well as a verbatim copy,
and the latter also if its case was changed.

An item of two to four words has no window of five: it is found where all its words stand one after the other, whatever the case. An item
of one word is no passage, and is found in the texts that consist of it alone.

Before the joins, document windows pass a bit table of fixed size that marks both hashes of the benchmark, whatever its size; what
it lets through by chance ends in the joins.

Defined cases. NULL ids of documents or items are never reported. NULL and empty texts, and items without wording (of no window, or
for short ones of no word), match nothing. Repeated rows of a document or an item give the same pair once, and so do several
places of one text; different texts under one id count as one. Texts of any length are used whole. Only ids and texts are read, so
other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import bit_table, marked, stored

WINDOW = 5
SHARE = 0.8
BIT_WORDS = 1 << 16
# Scripts that are written without spaces between words; all lie in the range, which is cheaper to test.
BEYOND = r"[\x{0E00}-\x{10FFFF}]"
UNSPACED = "".join(rf"\p{{Is{script}}}" for script in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))

# Units of measure that are replaced by a placeholder.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons ml l "
    "liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents percent degree degrees meter meters metre metres kilometer kilometers"
).split()

NUMBER, NAME, UNIT = "#", "@", "%"


def canonical(word: Column) -> Column:
    return (
        F.when((word >= "0") & (word < ":"), NUMBER).when(F.lower(word) != word, NAME).when(word.isin(UNITS), UNIT).otherwise(word)
    )


def folded(word: Column) -> Column:
    """Without case; the sharp s, whose upper case is two letters, folds to these."""
    return F.replace(F.lower(F.upper(word)), F.lit("ß"), F.lit("ss"))


def worded_texts(df: DataFrame, key: str) -> DataFrame:
    """(key, w, c): the words of every text, case-folded and as placeholders."""
    apart = F.regexp_replace("text", f"([{UNSPACED}])", " $1 ")
    text = F.when(F.col("text").rlike(BEYOND), apart).otherwise(F.col("text"))
    words = df.where(f"{key} IS NOT NULL AND text IS NOT NULL").select(key, F.array_remove(F.split(text, r"[^\p{L}\p{N}]+"), "").alias("w"))
    return words.select(key, F.transform("w", folded).alias("w"), F.transform("w", canonical).alias("c"))


def cut(texts: DataFrame, key: str, parts: list[str], size: int) -> DataFrame:
    """(key, pos, parts): every window of `size` words; part `w1` is its second word of `w`."""
    length = F.greatest(F.size("w") - (size - 1), F.lit(0))
    sides = texts.select(key, *[F.slice(p[0], int(p[1]) + 1, length).alias(p) for p in parts])
    return sides.select(key, F.posexplode(F.arrays_zip(*parts)).alias("pos", "z")).select(key, "pos", *[f"z.{p}" for p in parts])


def windows(df: DataFrame, key: str) -> DataFrame:
    """(key, pos, h, g, c0..c4, w0..w4): every window as placeholders (c) and as case-folded words (w), and the hashes of both."""
    parts = [f"{kind}{k}" for kind in "cw" for k in range(WINDOW)]
    rows = cut(worded_texts(df, key), key, parts, WINDOW)
    return rows.select(key, "pos", F.xxhash64(*parts[:WINDOW]).alias("h"), F.xxhash64(*parts[WINDOW:]).alias("g"), *parts)


def short_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id) of the items of fewer words than a window that stand in documents."""
    wording = F.exists("c", lambda c: ~c.isin(NUMBER, NAME, UNIT))
    some = worded_texts(benchmark, "item_id").where(F.size("w").between(1, WINDOW - 1)).where(wording)
    items = stored(some.select("item_id", F.size("w").alias("n"), F.array_join("w", " ").alias("said")).distinct(), "short-items")
    texts = worded_texts(docs, "doc_id")
    found = docs.sparkSession.createDataFrame([], "doc_id bigint, said string")
    # At most four sizes, of which documents are cut only into those that items have.
    for (size,) in items.select("n").distinct().collect():
        parts = [f"w{k}" for k in range(size)]
        told = cut(texts if size > 1 else texts.where(F.size("w") == 1), "doc_id", parts, size).select("doc_id", F.concat_ws(" ", *parts).alias("said"))
        found = found.unionByName(told)
    hashed = found.withColumn("h", F.xxhash64("said"))
    passed = marked(hashed, "h", bit_table(items.select(F.xxhash64("said").alias("h")), BIT_WORDS), BIT_WORDS)
    return passed.select("doc_id", "said").distinct().join(items.select("item_id", "said"), "said").select("doc_id", "item_id").distinct()


def worded() -> Column:
    """Whether some word of the window is not a placeholder."""
    return ~F.array_min(F.array(*[F.col(f"c{k}").isin(NUMBER, NAME, UNIT) for k in range(WINDOW)]))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched, share) of the items found in documents."""
    items = stored(windows(benchmark.select("item_id", "text"), "item_id").where(worded()), "items")
    sizes = items.groupBy("item_id").agg(F.countDistinct("pos").alias("n_windows"))
    table = bit_table(items.select("h").union(items.select("g")), BIT_WORDS)
    found = stored(marked(windows(docs.select("doc_id", "text"), "doc_id"), ["h", "g"], table, BIT_WORDS), "found")
    theirs = items.select("item_id", F.col("pos").alias("item_pos"), F.col("h").alias("item_h"), F.col("g").alias("item_g"), *[F.col(f"c{k}").alias(f"t{k}") for k in range(WINDOW)], *[F.col(f"w{k}").alias(f"v{k}") for k in range(WINDOW)])
    same = F.col("h") == F.col("item_h")
    verbatim = F.col("g") == F.col("item_g")
    for k in range(WINDOW):
        same = same & (F.col(f"c{k}") == F.col(f"t{k}"))
        verbatim = verbatim & (F.col(f"w{k}") == F.col(f"v{k}"))
    slots = F.filter(
        F.array(*[F.struct(F.col(f"c{k}").isin(NUMBER, NAME, UNIT).alias("slot"), F.col(f"v{k}").alias("asked"), F.col(f"w{k}").alias("told")) for k in range(WINDOW)]), lambda x: x.slot
    )
    matched = stored(found.join(theirs, same).select("doc_id", "item_id", "item_pos", (F.col("pos") - F.col("item_pos")).alias("diagonal"), slots.alias("slots")), "matched")
    place = ["doc_id", "item_id", "diagonal"]
    values = matched.select(*place, F.explode("slots").alias("s")).select(*place, "s.asked", "s.told").distinct()
    torn = values.groupBy(*place, "asked").agg(F.count("*").alias("n")).where("n > 1").select(*place).distinct()
    place_of_item = ["doc_id", "item_id", "item_pos"]
    by_either = matched.join(torn, place, "left_anti").select(*place_of_item).union(found.join(theirs, verbatim).select(*place_of_item))
    covered = by_either.groupBy("doc_id", "item_id").agg(F.countDistinct("item_pos").alias("n_matched"))
    long = covered.join(sizes, "item_id").where(F.col("n_matched") >= SHARE * F.col("n_windows"))
    whole = F.lit(1).cast("bigint")
    short = short_items(docs.select("doc_id", "text"), benchmark.select("item_id", "text")).join(sizes, "item_id", "left_anti")
    every = long.select("doc_id", "item_id", "n_windows", "n_matched").unionByName(short.select("doc_id", "item_id", whole.alias("n_windows"), whole.alias("n_matched")))
    return every.withColumn("share", F.col("n_matched") / F.col("n_windows"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` in which no item is found."""
    return docs.join(contaminated(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
