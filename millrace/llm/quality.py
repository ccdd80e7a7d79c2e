"""Quality rules whose thresholds follow each language and source.

Every measure of a text is a whole number.  Its quantile sketch in a group is
the number of texts per bucket, where buckets grow with the value; sketches of
parts are merged by adding the counts, in any order, with one and the same
result.  From the sketches of a source, and of its whole language, come a
median and quartiles, and from these the limits beyond which a text is dropped.
Only DataFrame functions are used.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import listed
from millrace.session import materialise, unused_name

BREAKS = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


class Measure(NamedTuple):
    """A limit is a quartile plus ``spread`` interquartile ranges plus ``slack``."""

    name: str
    spread: int
    slack: int
    both_sides: bool = False


MEASURES = (
    Measure("symbols", 3, 150),  # per 1000 words
    Measure("repeated", 3, 300),  # words in repeated windows, per 1000 words
    Measure("equal_lines", 3, 400),  # per 1000 lines with a word
    Measure("word_length", 4, 300, both_sides=True),  # 100 x mean
)


class Settings(NamedTuple):
    """``weight`` texts of its language count as much as the source itself."""

    least_words: int = 50
    most_repeated: int = 50
    weight: int = 200


def with_counts(df: DataFrame, text: Column, into: str) -> DataFrame:
    """``df`` with a struct column ``into`` of what is counted in a text.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines.  A null text has no words.  Every step that is used more than once
    is a plain column of its own: Spark then works it out once, which it would
    not do for the fields of a struct.
    """
    steps = "text spaced parts lines hashes windows sorted same at words chars symbols dups covered".split()
    names = {step: unused_name(df, f"_{into}_{step}") for step in steps}
    part = lambda step: F.col(names[step])

    def add(**columns):
        nonlocal df
        df = df.withColumns({names[step]: column for step, column in columns.items()})

    add(text=F.coalesce(text, F.lit("")))
    add(spaced=F.translate(part("text"), BREAKS, " " * len(BREAKS)))
    add(
        parts=F.split(part("spaced"), " ", -1),
        lines=F.filter(F.split(part("text"), "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        symbols=F.length(part("text")) - F.length(F.translate(part("text"), SYMBOLS, "")),
    )
    add(
        hashes=F.transform(F.array_remove(part("parts"), ""), lambda word: F.xxhash64(word)),
        chars=F.length(part("spaced")) - F.size(part("parts")) + 1,
        dups=F.size(part("lines")) - F.size(F.array_distinct(part("lines"))),
    )
    hashes, count = part("hashes"), F.greatest(F.size(part("hashes")) - 2, F.lit(0))
    pairs = F.zip_with(F.slice(hashes, 1, count), F.slice(hashes, 2, count), lambda a, b: F.xxhash64(a, b))
    add(
        words=F.size(hashes),
        windows=F.zip_with(pairs, F.slice(hashes, 3, count), lambda a, b: F.xxhash64(a, b)),
    )
    # Most texts repeat no window; only the others are sorted.
    placed = F.transform(part("windows"), lambda x, at: F.struct(x.alias("x"), at.alias("at")))
    repeats = F.size(F.array_distinct(part("windows"))) < F.size(part("windows"))
    add(sorted=F.when(repeats, F.array_sort(placed)))
    found, size = part("sorted"), F.size(part("sorted"))
    equal = F.zip_with(found, F.slice(found, 2, size), lambda a, b: F.coalesce(a["x"] == b["x"], F.lit(False)))
    add(same=F.when(found.isNotNull(), equal))
    earlier = F.slice(F.concat(F.array(F.lit(False)), part("same")), 1, size)
    either = F.zip_with(part("same"), earlier, lambda a, b: a | b)
    add(at=F.array_sort(F.array_compact(F.zip_with(found, either, lambda a, b: F.when(b, a["at"])))))
    at = part("at")
    reach = F.zip_with(at, F.slice(at, 2, F.size(at)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    total = F.aggregate(reach, F.lit(0), lambda so_far, n: so_far + n)
    add(covered=F.when(at.isNull(), F.lit(0)).otherwise(total), lines=F.size(part("lines")))
    counts = {
        "n_words": "words",
        "word_chars": "chars",
        "n_symbols": "symbols",
        "n_dup_lines": "dups",
        "n_repeat_words": "covered",
        "n_lines": "lines",
    }
    fields = F.struct(*(part(step).cast("long").alias(name) for name, step in counts.items()))
    return df.withColumn(into, fields).drop(*names.values())


def base_failed(counts: str, settings: Settings) -> Column:
    few = F.col(f"{counts}.n_words") < settings.least_words
    return few | (100 * F.col(f"{counts}.n_repeat_words") > settings.most_repeated * F.col(f"{counts}.n_words"))


def measures(counts: str) -> dict[str, Column]:
    """The measures of a text with words, as whole numbers."""
    c = lambda name: F.col(f"{counts}.{name}")
    words, lines = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1))
    rates = {
        "symbols": (1000 * c("n_symbols"), words),
        "repeated": (1000 * c("n_repeat_words"), words),
        "equal_lines": (1000 * c("n_dup_lines"), lines),
        "word_length": (100 * c("word_chars"), words),
    }
    return {name: F.floor(a / b).cast("long") for name, (a, b) in rates.items()}


def bucket(value: Column) -> Column:
    """Lower end of the bucket of a whole number: single up to 63, then 32 to each doubling."""
    unit = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(value)) - 6, F.lit(0))).cast("long")
    return value - F.pmod(value, unit)


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per group and measure: texts, and the buckets of the three quartiles."""
    order = Window.partitionBy(*keys, "measure").orderBy("bucket")
    whole = Window.partitionBy(*keys, "measure")
    placed = sketch.withColumns(
        {"upto": F.sum("texts").over(order), "all_texts": F.sum("texts").over(whole)}
    )
    at = lambda quarter: F.min(F.when(4 * F.col("upto") >= quarter * F.col("all_texts"), F.col("bucket")))
    return placed.groupBy(*keys, "measure").agg(
        F.first("all_texts").alias("texts"), at(1).alias("q1"), at(2).alias("q2"), at(3).alias("q3")
    )


def thresholds(counted: DataFrame, counts: str, lang: str, source: str, settings=Settings()) -> DataFrame:
    """(lang, source, limits): per measure the lowest and highest allowed value.

    ``limits`` is a struct with fields ``<measure>_low`` and ``<measure>_high``.
    Only texts that pass the base rules enter the sketches.  ``counted`` should
    be a written table, as its counts are used several times over.
    """
    values = measures(counts)
    sound = counted.filter(~base_failed(counts, settings)).select(
        F.col(lang).alias("lang"),
        F.col(source).alias("source"),
        F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), bucket(v).alias("bucket")) for n, v in values.items()))).alias("m"),
    )
    fine = sound.groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count(F.lit(1)).alias("texts"))
    coarse = fine.groupBy("lang", "measure", "bucket").agg(F.sum("texts").alias("texts"))
    own = _quartiles(fine, ["lang", "source"])
    shared = _quartiles(coarse, ["lang"]).select(
        F.col("lang").alias("of"), F.col("measure").alias("what"), *(F.col(q).alias(f"all_{q}") for q in ("q1", "q2", "q3"))
    )
    both = own.join(shared, F.col("lang").eqNullSafe(F.col("of")) & (F.col("measure") == F.col("what")))

    def mixed(name):
        total = F.col("texts") * F.col(name) + settings.weight * F.col(f"all_{name}")
        return F.floor(total / (F.col("texts") + settings.weight)).cast("long")

    limits = []
    for m in MEASURES:
        wide = F.lit(m.spread) * (mixed("q3") - mixed("q1")) + m.slack
        own_rows = F.col("measure") == m.name
        limits.append(F.max(F.when(own_rows, mixed("q3") + wide)).alias(f"{m.name}_high"))
        low = mixed("q1") - wide if m.both_sides else F.lit(0)
        limits.append(F.max(F.when(own_rows, low)).alias(f"{m.name}_low"))
    wide_rows = both.groupBy("lang", "source").agg(*limits)
    names = [f"{m.name}_{side}" for m in MEASURES for side in ("high", "low")]
    return wide_rows.select("lang", "source", F.struct(*names).alias("limits"))


def within(counts: str, limits: str) -> Column:
    """Whether every measure is inside its limits; without limits nothing is outside."""
    checks = F.lit(True)
    for m in MEASURES:
        value = measures(counts)[m.name]
        checks = checks & F.coalesce(value.between(F.col(f"{limits}.{m.name}_low"), F.col(f"{limits}.{m.name}_high")), F.lit(True))
    return checks


def judged(counted: DataFrame, limits: DataFrame, counts: str, lang="lang", source="source", settings=Settings()):
    """``counted`` with boolean columns ``base_failed`` and ``kept``.

    ``limits`` comes from ``thresholds``.  A text without words fails.  Null
    languages and sources are groups of their own; a group without limits has
    no limits.
    """
    of, by, cut = (unused_name(counted, n) for n in ("_lang", "_source", "_limits"))
    limits = limits.select(F.col("lang").alias(of), F.col("source").alias(by), F.col("limits").alias(cut))
    joined = counted.join(limits, F.col(lang).eqNullSafe(F.col(of)) & F.col(source).eqNullSafe(F.col(by)), "left")
    failed = base_failed(counts, settings)
    # One expression over both sides, which stays above the join.
    kept = F.when(failed, F.lit(False)).otherwise(within(counts, cut))
    return joined.withColumns({"base_failed": failed, "kept": kept}).drop(of, by, cut)


def quality(docs: DataFrame, id_col="doc_id", lang="lang", source="source", text="text", settings=Settings()) -> DataFrame:
    """(id, the counts, base_failed, kept) for every row of ``docs``.

    A null or empty text has no words and fails.  Rows without an id and
    repeated rows are judged like any other.  Other columns are not read.
    """
    own = docs.select(
        F.col(id_col).alias("id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).cast("string").alias("text")
    )
    counted, _ = materialise(with_counts(own, F.col("text"), "counts").drop("text"), "counts")
    limits = listed(thresholds(counted, "counts", "lang", "source", settings), "limits")
    found = judged(counted, limits, "counts", settings=settings)
    return found.select(F.col("id").alias(id_col), "counts.*", "base_failed", "kept")


def kept_documents(docs: DataFrame, lang="lang", source="source", text="text", settings=Settings()) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns."""
    counts = unused_name(docs, "_counts")
    own = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).cast("string").alias("text"))
    narrow, _ = materialise(with_counts(own, F.col("text"), "counts").drop("text"), "counts")
    limits = listed(thresholds(narrow, "counts", "lang", "source", settings), "limits")
    counted = with_counts(docs.select([F.col(c).alias(f"in_{c}") for c in docs.columns]), F.col(f"in_{text}").cast("string"), counts)
    found = judged(counted, limits, counts, f"in_{lang}", f"in_{source}", settings)
    return found.filter("kept").select([F.col(f"in_{c}").alias(c) for c in docs.columns])
