"""Random strings: their controls against every piece tested, and spans around plain ones."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import secret_scan as scan

ALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(12)
    words = ["".join(draw.choice("etaoinshrdlu") for _ in range(draw.randrange(2, 9))) for _ in range(200)]
    return [" ".join(draw.choice(words) for _ in range(150)) for _ in range(60)]


def test_controls_that_are_not_tested_could_not_be_accepted(spark, texts):
    pieces = [t.replace(" ", "")[:n] for t in texts[:20] for n in scan.LENGTHS] + ["abcdefabcdefabcd", "fedcbaabcdefabcdeffedcba"]
    rows = spark.createDataFrame([(p, len(p)) for p in pieces], "x string, n int")
    got = rows.select(
        "x", "n", scan._control_deviation(F.col("x"), F.col("n")).alias("taken"),
        scan._tenths(scan._deviation(F.col("x"), scan.BASE64, scan.NOT_SMALL)).alias("full"),
    ).collect()
    most = 10 * scan.Settings().most_deviation
    for r in got:
        if re.fullmatch("[a-f]+", r["x"]):
            continue
        assert r["taken"] <= r["full"]
        assert r["taken"] == r["full"] if r["n"] == 16 else r["taken"] > most


def test_the_rest_of_a_string_around_a_plain_span_goes_too(spark, texts):
    draw = random.Random(13)
    key = "deadbeef0123456789abcdef01" + "".join(draw.choice(ALL) for _ in range(30))
    rows = [(n, t) for n, t in enumerate(texts)] + [(1_000, f"see {key} here"), (1_001, "password=abcdef0123456789abcdef0123")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in scan.secrets(docs).collect()}
    base, spans = ([tuple(s) for s in found[1_000][c]] for c in ("base", "spans"))
    # The plain hexadecimal span stays as it is, and the method adds the whole string.
    assert base[0][:2] == (4, 2) and base[0][2] < 4 + len(key)
    assert set(base) <= set(spans) and (4, 3, 4 + len(key)) in spans
    clean = {r["doc_id"]: r["text"] for r in scan.redacted(docs).collect()}
    assert clean[1_000] == "see [SECRET] here" and clean[1_001] == "[SECRET]"
    # Inside a plain span the method adds nothing.
    assert [tuple(s) for s in found[1_001]["spans"]] == [tuple(s) for s in found[1_001]["base"]]
    assert all(not found[n]["spans"] for n in range(60))
