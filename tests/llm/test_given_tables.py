"""Facts that the operators must hold to on the given tables."""

import html
import random
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from millrace.llm.class_bigrams import score_texts
from millrace.llm.page_text import main_text

PAGES = "/root/testdata/sf0.1/pages.parquet"
#: What is no part of an article's text, wherever it stands.
OUTSIDE = re.compile(
    r'<!--.*?-->|<(script|style|aside|nav|form|figure|footer|header)\b.*?</\1>|<div class="?(?:ad|share|related|comments?)"?.*?</div>',
    re.S,
)


def test_no_paragraph_of_an_article_is_lost():
    table = pq.read_table(PAGES, columns=["page_id", "html"]).to_pydict()
    seen, lost = 0, []
    for page, markup in zip(table["page_id"], table["html"]):
        article = re.search(r"<article[^>]*>(.*?)</article>", markup, re.S)
        lines = set(main_text(markup).split("\n"))
        for part in re.findall(r"<p[^>]*>(.*?)(?=</p>|<p\b|<br>|$)", OUTSIDE.sub("", article.group(1)), re.S):
            text = " ".join(html.unescape(re.sub(r"<[^>]+>", "", part)).split())
            seen += bool(text)
            if text and text not in lines:
                lost.append((page, text))
    assert seen > 20_000 and lost == []


def test_a_list_of_names_stays_and_an_offer_goes():
    prose = "<p>" + "This is what the town has to say of the people who live in it and of those who do not. " * 3 + "</p>"
    names = "<p>" + "Berlin Hamburg Bremen Dresden Leipzig Rostock Kassel Erfurt Potsdam Schwerin Mainz Saarland Kiel Trier Worms Speyer " * 2 + "</p>"
    offer = "<p>" + "Laptop Zubehör Sonderposten Restposten Markenware Neuware Lagerräumung Versandkostenfrei Express Rabatt 40 % Preis € 99 " * 2 + "</p>"
    page = f"<html><body><article>{prose}{names}{prose}{offer}{prose}</article></body></html>"
    lines = main_text(page).split("\n")
    assert sum(line.startswith("Berlin") for line in lines) == 1 and not any(line.startswith("Laptop") for line in lines)
    assert len(lines) == 4


def test_made_up_words_score_worse_than_any_text(spark):
    draw = random.Random(11)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    made = [" ".join("".join(draw.choice("bcdfgklmnprst") + draw.choice("aeiou") for _ in range(4)) + str(n) for n in range(200)) for _ in range(3)]
    both = docs.unionByName(spark.createDataFrame([(-1 - n, t) for n, t in enumerate(made)], docs.schema))
    learned = (F.col("doc_id") >= 0) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
    scored = score_texts(both, learned).withColumn("mean", F.col("score") / F.col("n_tokens"))
    rows = {r["doc_id"]: r for r in scored.collect()}
    held = [r for key, r in rows.items() if key >= 0 and not r["learned"] and r["n_tokens"] > 20]
    assert max(rows[-1 - n]["mean"] for n in range(3)) < min(r["mean"] for r in held)
    # The model beats word frequencies on texts that it did not learn from.
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
