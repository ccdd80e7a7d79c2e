"""Secrets in texts: three fixed patterns, and strings that look random.

A string without white space that mixes letters and digits, or small letters and
capitals, is tested under the encoding it seems to have (hexadecimal, base 32 or
base 64; without digits base 64): a chi-squared test
that all characters of the alphabet are equally frequent, a runs test on the
class of the characters, and a test of serial correlation.  The sum of the
squared deviations is small for random strings.  Control strings are all letters
of the same texts with everything else taken out, in lower case and cut into
pieces; how often those reach a sum as small, among controls of about the same
length, is the p-value of a string, and 0 where no lower-case string can, which
the runs test tells whatever the number of controls.  The Benjamini-Hochberg rule bounds the false discoveries over all strings and
lengths.  Only DataFrame functions are used.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialise, unused_name

KINDS = ("assign", "access", "hex", "random")


class Pattern(NamedTuple):
    """``group`` of a match must have at least ``least`` characters."""

    regex: str
    group: int
    least: int


# The patterns of the three plain kinds.
PATTERNS = {
    "assign": Pattern(
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6
    ),
    "access": Pattern(r"AKIA[A-Z0-9]+", 0, 20),
    "hex": Pattern(r"[0-9a-f]+", 0, 24),
}
#: A quick test that a text can have a match of the kind at all.
HINTS = {"assign": PATTERNS["assign"].regex, "access": r"AKIA[A-Z0-9]{16}", "hex": r"[0-9a-f]{24}"}
STRING = r"[A-Za-z0-9+/_=-]{16,}"
LENGTHS = (16, 24, 32, 48, 64)

HEX = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
DIGITS, SMALL = "0123456789", "abcdefghijklmnopqrstuvwxyz"
NOT_SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + DIGITS + "+/"


class Settings(NamedTuple):
    """``rate``: allowed share of false discoveries.  ``most_deviation``: the sum
    of squares that one random string in a thousand exceeds (chi-squared, 3)."""

    rate: float = 0.01
    most_deviation: float = 16.27  # controls that cannot come below it are not tested


_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _none(kind: str) -> Column:
    return F.array().cast(kind)


def _matches(text: Column, pattern: Pattern, kind: int) -> Column:
    """Spans of the matches in code points: text between matches is counted along."""
    whole = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(0))
    own = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(pattern.group))
    sizes = F.zip_with(whole, own, lambda a, b: F.struct(F.length(a).alias("size"), F.length(b).alias("own")))
    gaps = F.transform(F.split(text, pattern.regex, -1), lambda gap: F.length(gap))
    items = F.zip_with(gaps, sizes, lambda gap, m: F.struct(gap.alias("gap"), m["size"].alias("size"), m["own"].alias("own")))
    start = F.struct(F.lit(0).alias("at"), _none("array<struct<start:int,kind:int,end:int,own:int>>").alias("out"))

    def step(acc, item):
        first = acc["at"] + item["gap"]
        last = first + item["size"]
        span = F.struct(first.alias("start"), F.lit(kind).alias("kind"), last.alias("end"), item["own"].alias("own"))
        longer = F.struct(last.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))
        return F.when(item["size"].isNull(), acc).otherwise(longer)

    spans = F.filter(F.aggregate(items, start, step, lambda acc: acc["out"]), lambda s: s["own"] >= pattern.least)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def _plain_spans(text: Column, name: str) -> Column:
    found = _matches(text, PATTERNS[name], KINDS.index(name)).cast(_SPANS)
    return F.when(text.rlike(HINTS[name]), found).otherwise(_none(_SPANS))


def _deviation(x: Column, alphabet: str, first_class: str, only: str = "") -> Column:
    """Sum of squared deviations of the three tests from what is expected at random.

    ``first_class`` is a character class; runs are of characters inside and
    outside it.  ``only``: all that can occur in ``x``, none of it in the class.
    """
    size, n = len(alphabet), F.length(x).cast("double")
    inside = sum(1 for c in alphabet if c in first_class) / size
    letters = F.array(*(F.lit(c) for c in only or alphabet))
    squares = F.aggregate(
        letters, F.lit(0.0), lambda total, c: total + F.pow(F.length(x) - F.length(F.replace(x, c, F.lit(""))), F.lit(2.0))
    )
    spread = 2 / (9 * (size - 1))
    ratio = (squares * size / n - n) / (size - 1)
    uneven = (F.pow(F.greatest(ratio, F.lit(0.0)), F.lit(1 / 3)) - (1 - spread)) / spread**0.5
    marked = F.translate(F.translate(x, first_class, "\x01" * len(first_class)), alphabet, "\x02" * size)
    runs = F.lit(1.0) if only else F.length(F.regexp_replace(marked, "\x01+|\x02+", "x")).cast("double")
    pq = inside * (1 - inside)
    runs_off = (runs - 1 - 2 * pq * (n - 1)) / F.sqrt(2 * pq * (2 * n - 3 - 2 * pq * (3 * n - 5)))
    values = F.transform(F.split(x, "", -1), lambda c: F.instr(F.lit(alphabet), c) - (size + 1) / 2)
    values = F.slice(values, 1, F.length(x))
    products = F.zip_with(values, F.slice(values, 2, F.length(x)), lambda a, b: F.coalesce(a * b, F.lit(0.0)))
    serial = F.aggregate(products, F.lit(0.0), lambda total, p: total + p) / ((size**2 - 1) / 12 * F.sqrt(n - 1))
    return F.pow(F.greatest(uneven, F.lit(0.0)), F.lit(2.0)) + F.pow(runs_off, F.lit(2.0)) + F.pow(serial, F.lit(2.0))


def deviation(string: Column) -> Column:
    """The sum for the encoding a string seems to have, in tenths, 1000 at most."""
    bare = F.regexp_replace(F.translate(string, "-_", "+/"), "=+", "")
    found = (
        F.when(string.rlike(r"^[0-9a-f]+$"), _deviation(string, HEX, DIGITS))
        .when(string.rlike(r"^[0-9A-F]+$"), _deviation(F.lower(string), HEX, DIGITS))
        .when(string.rlike(r"^[A-Z2-7]+=*$"), _deviation(bare, BASE32, "234567"))
        .when(F.length(bare) >= LENGTHS[0], _deviation(bare, BASE64, NOT_SMALL))
        .otherwise(F.lit(100.0))
    )
    return _tenths(found)


def _tenths(found: Column) -> Column:
    return F.floor(10 * F.least(F.coalesce(found, F.lit(100.0)), F.lit(100.0))).cast("int")


def _control_deviation(letters: Column, length: Column) -> Column:
    """``deviation`` of a string of small letters, or what it has at least.

    In base 64 the runs test alone says of longer ones that no accepted string
    has so large a sum; that much counts as theirs, and nothing is tested.
    """
    out = F.when(letters.rlike("^[a-f]+$"), _tenths(_deviation(letters, HEX, DIGITS)))
    for n in LENGTHS:
        if least_of_letters(n) > 10 * Settings().most_deviation:
            out = out.when(length == n, F.lit(least_of_letters(n)))
    return out.otherwise(_tenths(_deviation(letters, BASE64, NOT_SMALL, only=SMALL)))


def least_of_letters(length: int) -> int:
    """What the runs test alone gives a base 64 string without digits and capitals, in tenths."""
    inside = len(NOT_SMALL) / len(BASE64)
    pq = inside * (1 - inside)
    return int(10 * (2 * pq * (length - 1)) ** 2 / (2 * pq * (2 * length - 3 - 2 * pq * (3 * length - 5))))


def _length_class(length: Column) -> Column:
    """The largest of LENGTHS that is not above a length of at least the first."""
    out = F.lit(LENGTHS[0])
    for least in LENGTHS[1:]:
        out = F.when(length >= least, F.lit(least)).otherwise(out)
    return out


_STRINGS = "array<struct<start:int,end:int,class:int,deviation:int>>"
_CONTROLS = "array<struct<class:int,deviation:int>>"


def _strings(text: Column) -> Column:
    """Spans of the strings that mix two kinds of characters, with their test result.

    Letters of one case alone are not told from words by the tests.
    """
    spans = _matches(text, Pattern(STRING, 0, LENGTHS[0]), KINDS.index("random"))
    cut = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), text.substr(s["start"] + 1, s["end"] - s["start"]).alias("string")))
    mixed = F.filter(cut, lambda s: s["string"].rlike("[0-9].*[A-Za-z]|[A-Za-z].*[0-9]|[a-z].*[A-Z]|[A-Z].*[a-z]"))
    tested = F.transform(
        mixed,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            _length_class(s["end"] - s["start"]).alias("class"),
            deviation(s["string"]).alias("deviation"),
        ),
    )
    hint = r"[A-Za-z0-9+/_=-]{15}"
    return F.when(text.rlike(hint), tested.cast(_STRINGS)).otherwise(_none(_STRINGS))


def _controls(letters: Column) -> Column:
    """Pieces of the letters of a text: one of each length from the start, then
    all that follows the longest, cut into the lengths in turn."""
    piece = lambda own, at, n: F.struct(F.lit(n).alias("class"), own.substr(at + 1, n).alias("letters"))
    first = F.array(*(piece(letters, 0, n) for n in LENGTHS))
    rest = F.substr(letters, F.lit(LENGTHS[-1] + 1))
    turns = F.regexp_extract_all(rest, F.lit(f".{{1,{sum(LENGTHS)}}}"), F.lit(0))
    cut = F.transform(turns, lambda own: F.array(*(piece(own, sum(LENGTHS[:at]), n) for at, n in enumerate(LENGTHS))))
    whole = F.filter(F.concat(first, F.flatten(cut)), lambda p: F.length(p["letters"]) == p["class"])
    return F.transform(whole, lambda p: F.struct(p["class"].alias("class"), _control_deviation(p["letters"], p["class"]).alias("deviation")))


def with_spans(df: DataFrame, text: Column, into: str) -> DataFrame:
    """``df`` with columns ``<into>_base`` (plain spans in order), ``<into>_strings``
    and ``<into>_controls`` (test results).  A null text is empty."""
    plain, control = unused_name(df, f"_{into}_text"), unused_name(df, f"_{into}_control")
    df = df.withColumn(plain, F.coalesce(text, F.lit("")))
    own = F.col(plain)
    df = df.withColumn(control, F.regexp_replace(F.lower(own), "[^a-z]", ""))
    base = F.sort_array(F.concat(*(_plain_spans(own, name) for name in PATTERNS)))
    return df.withColumns(
        {
            f"{into}_base": base,
            f"{into}_strings": _strings(own),
            f"{into}_controls": _controls(F.col(control)).cast(_CONTROLS),
        }
    ).drop(plain, control)


def limits(measured: DataFrame, into: str, settings=Settings()) -> dict[int, int]:
    """Per length class the largest deviation that counts as random.

    ``measured`` should be a written table.  Results are counted per class and
    tenth of a deviation, a table of some thousand rows whatever the number of
    texts, on which the p-values and the rule are worked out.
    """
    count = F.count(F.lit(1))
    strings = measured.select(F.explode(f"{into}_strings").alias("s")).groupBy("s.class", "s.deviation").agg(count.alias("found"))
    controls = measured.select(F.explode(f"{into}_controls").alias("s")).groupBy("s.class", "s.deviation").agg(count.alias("controls"))
    cells = strings.join(controls, ["class", "deviation"], "full").fillna(0, ["found", "controls"])
    of_class = Window.partitionBy("class")
    cells = cells.withColumn("upto", F.sum("controls").over(of_class.orderBy("deviation")))
    never = F.lit(False)
    for length in LENGTHS:
        never = never | (F.col("class") == length) & (F.col("deviation") < least_of_letters(length))
    share = (1 + F.col("upto")) / (1 + F.sum("controls").over(of_class))
    cells = cells.withColumn("p", F.when(never & (F.col("upto") == 0), 0.0).otherwise(share))
    cells = cells.withColumns(
        {
            "rank": F.sum("found").over(Window.partitionBy().orderBy("p").rangeBetween(Window.unboundedPreceding, 0)),
            "all": F.sum("found").over(Window.partitionBy()),
        }
    )
    cells = cells.withColumn("fine", F.col("p") * F.col("all") <= settings.rate * F.col("rank"))
    cells = cells.withColumn("cut", F.max(F.when(F.col("fine") & (F.col("found") > 0), F.col("p"))).over(Window.partitionBy()))
    most = int(10 * settings.most_deviation)
    kept = cells.filter((F.col("p") <= F.col("cut")) & (F.col("deviation") <= most))
    return {r["class"]: r["most"] for r in kept.groupBy("class").agg(F.max("deviation").alias("most")).collect()}


def all_spans(into: str, found: dict[int, int]) -> Column:
    """The plain spans and those of random strings that lie inside none of them, in order.

    A plain span inside a longer random string does not hide the rest of it.
    """
    base, strings = F.col(f"{into}_base"), F.col(f"{into}_strings")
    if not found:
        return base

    def random(s):
        allowed = F.lit(False)
        for length, most in found.items():
            allowed = allowed | ((s["class"] == length) & (s["deviation"] <= most))
        return allowed & ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))

    more = F.transform(
        F.filter(strings, random),
        lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), s["end"].alias("end")),
    )
    return F.sort_array(F.concat(base, more.cast(_SPANS)))


def written_out(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def secrets(docs: DataFrame, id_col="doc_id", text_col="text", settings=Settings()) -> DataFrame:
    """(id, base, spans) for every row of ``docs``: arrays of (start, kind, end).

    ``base`` has the plain spans, ``spans`` all; starts count code points, ends
    are exclusive, ``kind`` is a position in KINDS.  A null or empty text has
    none.  Rows without an id and repeated rows are scanned like any other.
    Other columns are not read.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    measured, _ = materialise(with_spans(own, F.col("text"), "s").drop("text"), "secrets")
    found = limits(measured, "s", settings)
    return measured.select(F.col("id").alias(id_col), F.col("s_base").alias("base"), all_spans("s", found).alias("spans"))


def redacted(docs: DataFrame, text_col="text", mark="[SECRET]", settings=Settings()) -> DataFrame:
    """``docs`` with every secret in its text replaced by ``mark``.

    Spans that overlap are replaced as one.  A null text stays null; all other
    columns stay as they are.
    """
    names = docs.columns
    inner = docs.select([F.col(c).alias(f"in_{c}") for c in names])
    text = F.col(f"in_{text_col}").cast("string")
    measured, _ = materialise(with_spans(docs.select(F.col(text_col).cast("string").alias("text")), F.col("text"), "s").drop("text"), "secrets")
    found = limits(measured, "s", settings)
    scanned = with_spans(inner, text, "s")
    scanned = scanned.withColumn("s_all", all_spans("s", found))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        before = F.concat(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        out = F.concat(acc["out"], F.when(s["start"] >= acc["at"], before).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], text.substr(acc["at"] + 1, F.length(text)))
    clean = F.when(F.size("s_all") > 0, F.aggregate("s_all", start, step, rest)).otherwise(text)
    return scanned.select([(clean if c == text_col else F.col(f"in_{c}")).alias(c) for c in names])
