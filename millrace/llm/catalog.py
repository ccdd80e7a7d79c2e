"""The registered queries of the corpus operators, with SQL where it can express them."""

import public_tokenizers
from pyspark.sql import functions as F

from millrace.llm.byte_pairs import encode_and_decode
from millrace.llm.class_bigrams import score_texts
from millrace.llm.embedding_duplicates import near_vectors
from millrace.llm.frames import held_out, load
from millrace.llm.license_scan import licenses
from millrace.llm.near_duplicates import near_duplicates
from millrace.llm.neighbours import nearest
from millrace.llm.packing import pack_documents
from millrace.llm.page_text import page_texts
from millrace.llm.periodic_runs import periodic_runs
from millrace.llm.phrases import collocations
from millrace.llm.quality import quality
from millrace.llm.secret_scan import KINDS, PATTERNS, secrets, written_out
from millrace.llm.toxicity import toxicity
from millrace.session import pin_settings

_queries, _oracles = {}, {}


def query(name, sql=None):
    def register(build):
        def run(spark, sf_dir):
            return build(pin_settings(spark), sf_dir.rstrip("/"))

        run.__name__, run.__doc__ = name, build.__doc__
        _queries[name] = run
        if sql is not None:
            _oracles[name] = sql
        return build

    return register


def queries():
    return dict(_queries)


def oracles():
    return dict(_oracles)


NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM lowered
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
linked AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION SELECT reach.doc_id, linked.b FROM reach JOIN linked ON reach.other = linked.a
)
SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, min(other) AS component_id, sets.doc_id = min(other) AS kept
FROM sets JOIN reach ON sets.doc_id = reach.doc_id GROUP BY sets.doc_id, len(s)
"""


QUALITY_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT k, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM texts
), windows AS (
  SELECT k, unnest(range(1, len(w) - 1)) AS place, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS x
  FROM words
), again AS (
  SELECT k, place FROM (SELECT k, place, count(*) OVER (PARTITION BY k, x) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT k, count(DISTINCT place + step) AS n FROM again, (SELECT unnest([0, 1, 2]) AS step) GROUP BY k
), counted AS (
  SELECT texts.*, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(l)::BIGINT AS n_lines
  FROM texts JOIN words USING (k) LEFT JOIN repeated USING (k)
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
), measured AS (
  SELECT k, lang, source, base_failed, unnest(['symbols', 'repeated', 'equal_lines', 'word_length']) AS measure,
    unnest([1000 * n_symbols // greatest(n_words, 1), 1000 * n_repeat_words // greatest(n_words, 1),
            1000 * n_dup_lines // greatest(n_lines, 1), 100 * word_chars // greatest(n_words, 1)]) AS v
  FROM based
), bucketed AS (
  SELECT *, v - v % (1 << greatest(length(bin(v)) - 6, 0)::INT) AS bucket FROM measured WHERE NOT base_failed
), fine AS (
  SELECT lang, source, measure, bucket, count(*) AS n FROM bucketed GROUP BY ALL
), fine_upto AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY lang, source, measure) AS total FROM fine
), own AS (
  SELECT lang, source, measure, any_value(total) AS n, min(bucket) FILTER (4 * upto >= total) AS q1,
    min(bucket) FILTER (4 * upto >= 3 * total) AS q3 FROM fine_upto GROUP BY ALL
), coarse AS (
  SELECT lang, measure, bucket, sum(n) AS n FROM fine GROUP BY ALL
), coarse_upto AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, measure ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY lang, measure) AS total FROM coarse
), shared AS (
  SELECT lang, measure, min(bucket) FILTER (4 * upto >= total) AS all_q1,
    min(bucket) FILTER (4 * upto >= 3 * total) AS all_q3 FROM coarse_upto GROUP BY ALL
), mixed AS (
  SELECT own.lang, source, own.measure, (n * q1 + 200 * all_q1) // (n + 200) AS q1, (n * q3 + 200 * all_q3) // (n + 200) AS q3
  FROM own JOIN shared ON own.lang IS NOT DISTINCT FROM shared.lang AND own.measure = shared.measure
), rules AS (
  SELECT * FROM (VALUES ('symbols', 3, 150, false), ('repeated', 3, 300, false), ('equal_lines', 3, 400, false),
                        ('word_length', 4, 300, true)) AS r(measure, spread, slack, both_sides)
), limits AS (
  SELECT lang, source, measure, q3 + spread * (q3 - q1) + slack AS high,
    CASE WHEN both_sides THEN q1 - spread * (q3 - q1) - slack ELSE 0 END AS low FROM mixed JOIN rules USING (measure)
), verdicts AS (
  SELECT k, bool_and(coalesce(v BETWEEN low AND high, true)) AS fits
  FROM measured LEFT JOIN limits ON measured.measure = limits.measure AND measured.lang IS NOT DISTINCT FROM limits.lang
    AND measured.source IS NOT DISTINCT FROM limits.source GROUP BY k
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND fits AS kept
FROM based JOIN verdicts USING (k)
"""


NEAR_VECTORS_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), degrees AS (
  SELECT a, count(*) AS n FROM linked GROUP BY a
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT reach.vec_id, linked.b FROM reach JOIN linked ON reach.other = linked.a
)
SELECT reach.vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(other) AS component_id,
  reach.vec_id = min(other) AS kept
FROM reach LEFT JOIN degrees ON reach.vec_id = degrees.a GROUP BY reach.vec_id
"""


PERIODIC_RUNS_SQL = r"""
WITH digits AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS d FROM documents
), hashed AS (
  SELECT k, doc_id, w, len(w) AS n, xor(4294967295, list_reduce(
    list_concat([4294967295], d), lambda c, x: list_reduce(
      list_concat([xor(c, x)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) AS h FROM digits
), cut AS (
  SELECT *, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a FROM hashed
), dealt AS (
  SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM cut
), texts AS (
  SELECT k, doc_id, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE w END AS w
  FROM dealt
), words AS (
  SELECT k, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM texts
), agreeing AS (
  SELECT a.k, a.i, b.i - a.i AS q FROM words a JOIN words b ON a.k = b.k AND a.x = b.x AND a.i < b.i
  WHERE 2 * (b.i - a.i) <= a.n
), stretches AS (
  SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS stretch FROM agreeing
), repeats AS (
  SELECT k, q, min(i) AS s, count(*) + q AS l FROM stretches GROUP BY k, q, stretch
  HAVING count(*) + q >= greatest(12, 2 * q)
), runs AS (
  SELECT k, s, l, min(q) AS q FROM repeats GROUP BY k, s, l
), best AS (
  SELECT k, count(*) AS n_runs, first(s ORDER BY l DESC, s, q) AS start, first(l ORDER BY l DESC, s, q) AS length,
    first(q ORDER BY l DESC, s, q) AS period,
    string_agg(s::VARCHAR || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed
  FROM runs GROUP BY k
), dropped AS (
  SELECT DISTINCT k, unnest(range(s + q, s + l)) AS i FROM runs
), kept AS (
  SELECT k, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN dropped USING (k, i) GROUP BY k
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
  period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM texts LEFT JOIN best USING (k) LEFT JOIN kept USING (k)
"""


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), phrases AS (
  SELECT lang, unnest(flatten(list_transform([1, 2, 3], lambda k: list_transform(
    range(1, len(w) - k + 2), lambda i: {'size': k, 'phrase': array_to_string(w[i:i + k - 1], ' ')})))) AS p FROM words
), counted AS (
  SELECT lang, p.size AS size, p.phrase AS phrase, count(*) AS f FROM phrases GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT *, unnest(range(1, size)) AS k FROM candidates
), parts AS (
  SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail FROM cuts
), scored AS (
  SELECT parts.lang, parts.size, parts.phrase, a, k, h.f AS l, t.f AS r,
    (1000000::HUGEINT * a * a // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM parts JOIN counted h ON h.lang = parts.lang AND h.size = k AND h.phrase = head
  JOIN counted t ON t.lang = parts.lang AND t.size = parts.size - k AND t.phrase = tail
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
  FROM candidates WHERE size = 3
), covered AS (
  SELECT lang, phrase, max(a) AS most FROM longer GROUP BY lang, phrase
), kept AS (
  SELECT lowest.*, n FROM lowest JOIN totals USING (lang)
  LEFT JOIN covered ON covered.lang = lowest.lang AND covered.phrase = lowest.phrase AND size = 2
  WHERE most IS NULL OR 100 * most < 50 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""


@query("op10_near_duplicates", NEAR_DUPLICATES_SQL)
def op10(spark, sf_dir):
    """Near-duplicate groups of all documents."""
    return near_duplicates(load(spark, sf_dir, "documents"))


@query("op1_toxicity")
def op1(spark, sf_dir):
    """Toxicity of all documents, learned from the labels of four folds in five."""
    docs = load(spark, sf_dir, "documents")
    kept_back = held_out("doc_id", 5)
    scored = toxicity(docs, load(spark, sf_dir, "labels"), ~kept_back)
    return scored.select(
        "doc_id", kept_back.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op2_page_text")
def op2(spark, sf_dir):
    """Main text of all pages."""
    texts = page_texts(load(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query("op3_byte_pairs")
def op3(spark, sf_dir):
    """Token ids of all documents and the texts they decode to, as digests."""
    coded = encode_and_decode(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op4_license_scan")
def op4(spark, sf_dir):
    """Licenses found in all documents, with coverage and place."""
    return licenses(load(spark, sf_dir, "documents"))


@query("op5_nearest_neighbours")
def op5(spark, sf_dir):
    """The 20 nearest found of every twentieth embedding, among all others."""
    return nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op6_quality_rules", QUALITY_SQL)
def op6(spark, sf_dir):
    """Quality counts and verdicts of all documents."""
    return quality(load(spark, sf_dir, "documents")).drop("n_lines")


@query("op7_secret_scan")
def op7(spark, sf_dir):
    """Secrets of all documents: counts and spans."""
    found = secrets(load(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in PATTERNS),
        F.sha2(written_out(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written_out(F.col("spans")).alias("spans"),
    )


@query("op9_class_bigrams")
def op9(spark, sf_dir):
    """Log probabilities of all documents, learned from nine folds in ten."""
    scored = score_texts(load(spark, sf_dir, "documents"), ~held_out("doc_id", 10))
    return scored.withColumn("held_out", ~F.col("learned")).drop("learned")


@query("op8_best_fit_packing")
def op8(spark, sf_dir):
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op11_embedding_duplicates", NEAR_VECTORS_SQL)
def op11(spark, sf_dir):
    """Links and groups of all embeddings with a cosine of at least 0.9."""
    return near_vectors(load(spark, sf_dir, "embeddings"))


def with_repeated_tails(docs, id_col="doc_id", text_col="text"):
    """Texts in one of ten of which the words from a place on repeat with a period.

    With h the CRC-32 of the id as text and g = h / 10, texts with h % 10 = 0
    repeat from word g % n on with the period 1 + (n - a) / (3 + g % 8).
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(given):
        words, g = given["words"], given["g"]
        n = F.size(words)
        start = (g % n).cast("int")
        period = (F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8))).cast("int")
        times = F.ceil((n - start) / period).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(words, start + 1, period), times)), 1, n - start)
        return F.array_join(F.concat(F.slice(words, 1, start), tail), " ")

    # Binding the words to a name keeps them from being split off again for every use.
    bound = F.array(F.struct(words.alias("words"), F.floor(h / 10).alias("g")))
    changed = F.transform(F.filter(bound, lambda b: F.size(b["words"]) > 0), repeated)[0]
    return docs.withColumn(text_col, F.when(h % 10 == 0, F.coalesce(changed, text_col)).otherwise(F.col(text_col)))


@query("op12_periodic_runs", PERIODIC_RUNS_SQL)
def op12(spark, sf_dir):
    """Periodic runs of all documents, and the texts without their repeats, as digests."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(with_repeated_tails(docs))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-longest["start"]).alias("start"),
        longest["length"].alias("length"),
        (-longest["period"]).alias("period"),
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op13_collocations", COLLOCATIONS_SQL)
def op13(spark, sf_dir):
    """The 2000 strongest phrases of each lang in all documents."""
    return collocations(load(spark, sf_dir, "documents"))
