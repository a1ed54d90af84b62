"""A query per operator over the test tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.fixtures import table
from corpusloom.llm import decontaminate, html_text, language, line_dedup, mixing, negatives, periodic, pieces, pii, sharding, simhash, token_counts, topk

# A key for tests; in use, a secret that never stands in code.
TEST_KEY = b"test key"


def op1_sentencepiece(spark, sf_dir):
    """Ids of every text, and whether decoding them gives the text back."""
    done = pieces.round_trip(table(spark, sf_dir, "documents").withColumn("text", F.coalesce("text", F.lit(""))).select("doc_id", "text"))
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_xxh64"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_line_dedup(spark, sf_dir):
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages))


def op4_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op5_token_counts(spark, sf_dir):
    return token_counts.tokens_by_line(table(spark, sf_dir, "documents"))


def op6_shards(spark, sf_dir):
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


def op7_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_decontaminate(spark, sf_dir):
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_pii(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents"), TEST_KEY).select("doc_id", "text", F.size("kinds").cast("long").alias("n_replaced"), F.array_join("kinds", ",").alias("kinds"))


def op10_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def _with_periods(docs):
    """The documents whose crc32(doc_id) is divisible by 10, their words repeating from some word on; others as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(w):
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.transform(w, lambda word, i: F.when(i < a, word).otherwise(F.get(w, (a + (i - a) % p).cast("int"))))

    # An array of one binds the words to a name, so that they are split once and not for every word.
    text = F.array_join(F.transform(F.array(words), repeated)[0], " ")
    return docs.select("doc_id", F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text"))


def op11_runs(spark, sf_dir):
    found = periodic.find_runs(_with_periods(table(spark, sf_dir, "documents")))
    found = found.withColumn("top", periodic.longest_run("runs"))
    start, length, period = (F.col("top")[c] for c in ("start", "length", "period"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(periodic.runs_text(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(negatives.integer_vectors(table(spark, sf_dir, "embeddings"), label))


QUERIES = {f.__name__: f for f in (
    op1_sentencepiece, op2_line_dedup, op3_html_text, op4_language, op5_token_counts, op6_shards, op7_topk, op8_decontaminate, op9_pii, op10_simhash,
    op11_runs, op12_mix, op13_hard_negatives,
)}

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op2_line_dedup": f"""
WITH cut AS (
    SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT row_no, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM cut
), keyed AS (
    SELECT *, {_FOLD.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines
), shared AS (
    SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT k.*, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.last AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row_no
""",
    "op7_topk": """
WITH v AS (
    SELECT vec_id AS id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.id AS query_id, c.id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM v q JOIN v c ON q.id % 20 = 0 AND q.id <> c.id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op8_decontaminate": f"""
WITH d AS (
    SELECT row_number() OVER () AS row_no, doc_id,
        regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
    SELECT item_id::VARCHAR AS item, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), sized AS (
    SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
), grams AS (
    SELECT row_no, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
    FROM (SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
    SELECT g.row_no, g.i, g.n, x.item FROM grams g JOIN windows x ON g.n = x.n AND g.gram = x.gram
), words AS (
    SELECT row_no, count(*) AS n_hit FROM (SELECT DISTINCT row_no, unnest(range(i, i + n)) AS at FROM hits) GROUP BY row_no
), items AS (
    SELECT row_no, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY row_no
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row_no) LEFT JOIN items USING (row_no)
""",
    "op11_runs": """
WITH d AS (
    SELECT row_number() OVER () AS row_no, doc_id, string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') AS parts FROM documents
), cut AS (
    SELECT row_no, doc_id, [x FOR x IN parts IF x <> ''] AS w, list_reduce(
        list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')])),
        lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END
    ) AS crc FROM d
), hashed AS (
    SELECT row_no, doc_id, w, len(w) AS n, xor(crc, 4294967295) AS h, xor(crc, 4294967295) // 10 AS g FROM cut
), placed AS (
    SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM hashed
), words AS (
    SELECT row_no, n, a, p, unnest(range(n)) AS i, unnest(w) AS word FROM placed
), texts AS (
    SELECT row_no, n, i, word FROM words WHERE a IS NULL OR i < a
    UNION ALL
    SELECT t.row_no, t.n, t.i, o.word FROM words t JOIN words o ON o.row_no = t.row_no AND o.i = t.a + (t.i - t.a) % t.p WHERE t.i >= t.a
), grams AS (
    SELECT row_no, n, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram
    FROM texts WINDOW o AS (PARTITION BY row_no ORDER BY i) QUALIFY i + 5 <= n
), pairs AS (
    SELECT x.row_no, x.i, y.i - x.i AS d FROM grams x JOIN grams y ON x.row_no = y.row_no AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), chained AS (
    SELECT *, i - row_number() OVER (PARTITION BY row_no, d ORDER BY i) AS chain FROM pairs
), stretches AS (
    SELECT row_no, min(i) AS s, count(*) + 4 + d AS l, d FROM chained GROUP BY row_no, d, chain
), runs AS (
    SELECT row_no, s, l, min(d) AS q FROM stretches WHERE l >= greatest(6, 4 * d) GROUP BY row_no, s, l
), totals AS (
    SELECT row_no, count(*) AS n_runs, string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS lines,
        first(struct_pack(s := s, l := l, q := q) ORDER BY l DESC, s, q) AS top FROM runs GROUP BY row_no
), gone AS (
    SELECT DISTINCT row_no, unnest(range(s + q, s + l)) AS i FROM runs
), kept AS (
    SELECT t.row_no, string_agg(t.word, ' ' ORDER BY t.i) AS text FROM texts t ANTI JOIN gone g ON t.row_no = g.row_no AND t.i = g.i GROUP BY t.row_no
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.q AS period, 1000 * top.l // top.q AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM placed LEFT JOIN totals USING (row_no) LEFT JOIN kept USING (row_no)
""",
    "op12_mix": """
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
        ('0x' || substr(md5('mix' || chr(10) || coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 15))::BIGINT AS key
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
), weighed AS (
    SELECT *, [2.0, 3.0, 1.0][place % 3 + 1]::DOUBLE AS weight, 2 * words AS bound FROM totals
), ordered AS (
    SELECT *, coalesce(sum(bound) OVER before, 0)::DOUBLE AS bound_before, coalesce(sum(weight) OVER before, 0)::DOUBLE AS weight_before,
        (sum(words) OVER ())::DOUBLE * 1.5::DOUBLE AS wanted, sum(weight) OVER () AS weights, row_number() OVER sorted AS nr
    FROM weighed WINDOW sorted AS (ORDER BY bound / weight, place),
        before AS (ORDER BY bound / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT wanted - bound_before AS remaining, weights - weight_before AS shares FROM ordered
    WHERE bound * (weights - weight_before) > weight * (wanted - bound_before) ORDER BY nr LIMIT 1
), dealt AS (
    SELECT source, words, coalesce(least(bound::DOUBLE, weight * (SELECT remaining FROM level) / (SELECT shares FROM level)), bound::DOUBLE) AS target FROM ordered
), budgets AS (
    SELECT source, words, target, CASE WHEN words > 0 THEN floor(target)::BIGINT // words ELSE 0 END AS whole,
        CASE WHEN words > 0 THEN floor(target)::BIGINT % words ELSE 0 END AS rest FROM dealt
), keyed AS (
    SELECT source, key, sum(size) AS held FROM sized WHERE size > 0 GROUP BY source, key
), running AS (
    SELECT *, sum(held) OVER (PARTITION BY source ORDER BY key) - held AS before FROM keyed
), cut AS (
    SELECT r.source, r.key, b.rest - r.before AS missing, r.held FROM running r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
    WHERE r.before < b.rest AND b.rest <= r.before + r.held
)
SELECT s.doc_id, s.size, b.words AS source_size, b.target, (b.whole * s.size + CASE WHEN s.key < c.key THEN s.size
    WHEN s.key = c.key THEN s.size * c.missing // c.held ELSE 0 END)::BIGINT AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source LEFT JOIN cut c ON s.source IS NOT DISTINCT FROM c.source
""",
    "op13_hard_negatives": """
WITH v AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.id AS anchor_id, c.id AS id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
    FROM v a JOIN v c ON a.id % 50 = 0 AND a.id <> c.id AND len(a.v) = len(c.v)
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM scored WHERE same QUALIFY place <= 5
), windows AS (
    SELECT p.anchor_id, p.id AS positive_id, p.place, p.score AS positive_score, n.id AS negative_id, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.place ORDER BY n.score DESC, n.id)::INTEGER AS rank
    FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
        AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 3
""",
}
