"""Queries of the corpus operators over the given tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    common,
    decontaminate,
    jaccard_join,
    language,
    packing,
    prefix_trie,
    quality,
    spelling,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    topk,
    toxicity,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            common.ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def _settled(spark: SparkSession, operator) -> DataFrame:
    """The operator's result as a table of its own, without what it wrote on its way."""
    with common.scope() as own:
        found = operator()
    written = common.write_and_read(found, "result")
    common.clear(spark, own)
    return written


def _labelled(labels: DataFrame, column: str, parts: int, held_out: int) -> DataFrame:
    return labels.filter(common.fold("doc_id", parts) != held_out).select("doc_id", F.col(column).alias("label"))


def _judged(docs: DataFrame, parts: int, held_out: int) -> DataFrame:
    return docs.select(
        "doc_id",
        (common.fold("doc_id", parts) == held_out).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")
    lexicon = toxicity.learn(docs, _labelled(labels, "toxic", 5, 0))
    return _judged(toxicity.with_score(docs, lexicon), 5, 0)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.read(spark, sf_dir, "documents"))


SUFFIX_SQL = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    h AS (SELECT doc_id, upper(hex(b)) AS x, n FROM d),
    w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 200) AS s
        FROM (SELECT doc_id, x, unnest(range(0, greatest(n - 99, 0))) AS i FROM h)),
    r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
    g AS (SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM r),
    t AS (SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM g),
    c AS (SELECT doc_id, c, min(i) AS a, max(i) + 100 AS e FROM t GROUP BY doc_id, c),
    k AS (SELECT doc_id, e AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a), 1e15::BIGINT) AS z FROM c
        UNION ALL SELECT doc_id, 0 AS a, min(a) AS z FROM c GROUP BY doc_id),
    m AS (SELECT k.doc_id, string_agg(substr(h.x, 2 * k.a + 1, 2 * (least(k.z, h.n) - k.a)), '' ORDER BY k.a) AS x
        FROM k JOIN h USING (doc_id) GROUP BY k.doc_id),
    y AS (SELECT doc_id, sum(e - a) AS n_removed, count(*) AS n_spans FROM c GROUP BY doc_id)
SELECT h.doc_id, CAST(h.n AS BIGINT) AS n_bytes, CAST(coalesce(y.n_removed, 0) AS BIGINT) AS n_removed,
    CAST(coalesce(y.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(m.x, h.x))) AS kept_sha256
FROM h LEFT JOIN y USING (doc_id) LEFT JOIN m USING (doc_id)
"""


@query("op3_suffix_dedup", SUFFIX_SQL)
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return _settled(spark, lambda: suffix_dedup.remove_earlier_strings(docs).select(*columns))


SUBSTRING_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT r, i, array_to_string(w[i : i + 34], ' ') AS g
        FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM d)),
    t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS n FROM s) WHERE n > 1),
    x AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS k FROM t),
    k AS (SELECT d.r, w[u.k] AS word, u.k FROM (SELECT r, unnest(range(1, len(w) + 1)) AS k FROM d) u JOIN d USING (r)
        ANTI JOIN x ON u.r = x.r AND u.k = x.k),
    j AS (SELECT r, count(*) AS kept, string_agg(word, ' ' ORDER BY k) AS body FROM k GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN j USING (r)
"""


@query("op4_substring_dedup", SUBSTRING_SQL)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return _settled(spark, lambda: substring_dedup.remove_repeated_windows(docs).select(*columns))


DECONTAMINATE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
    p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM p),
    c AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
        FROM (SELECT r, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d, sizes)),
    m AS (SELECT c.r, c.i, c.n, p.item_id FROM c JOIN p ON c.s = p.s AND c.n = p.n),
    h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS k FROM m) GROUP BY r),
    t AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""


@query("op5_decontamination", DECONTAMINATE_SQL)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.benchmark_hits(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))
    return found.withColumn("n_hit", decontaminate.hit_words("runs")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


TOP_K_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT) FOR x IN embedding] AS q FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
            CAST(coalesce(list_sum([a.q[i] * b.q[i] FOR i IN range(1, least(len(a.q), len(b.q)) + 1)]), 0) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


@query("op6_exact_top_k", TOP_K_SQL)
def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(common.read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


JACCARD_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS g
        FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    o AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
    e AS (SELECT a, b FROM o JOIN n x ON o.a = x.r JOIN n y ON o.b = y.r WHERE 100 * o >= 75 * (x.n + y.n - o)),
    u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    c AS (SELECT r AS a, r AS b FROM d UNION SELECT c.a, u.b FROM c JOIN u ON c.b = u.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, t.component_id
FROM d LEFT JOIN n USING (r)
    JOIN (SELECT c.a AS r, min(k.doc_id) AS component_id FROM c JOIN d k ON c.b = k.r GROUP BY c.a) t USING (r)
"""


@query("op7_ngram_jaccard_join", JACCARD_SQL)
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return _settled(spark, lambda: jaccard_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id"))


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")
    machine = quality.learn(docs, _labelled(labels, "quality", 3, 1))
    return _judged(quality.with_score(docs, machine), 3, 1)


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(common.read(spark, sf_dir, "documents"))


@query("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    coder = language.learn(docs.filter(common.fold("doc_id", 3) != 1))
    return language.identify(docs.select("doc_id", "text"), coder).select(
        "doc_id", (common.fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


#: crc32 of a short text in SQL, as the table of one byte's steps; fixed polynomial.
CRC_TABLE = """
k AS (SELECT [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    FOR i IN range(256)] AS t)"""


def _crc(text: str) -> str:
    """SQL of the crc32 of a text of code points below 256; needs ``k`` beside it."""
    units = f"flatten([CASE WHEN unicode(u) < 128 THEN [unicode(u)::BIGINT] ELSE [195::BIGINT, unicode(u)::BIGINT - 64] END FOR u IN string_split({text}, '')])"
    steps = f"list_reduce(list_prepend(4294967295::BIGINT, {units}), lambda c, b: xor(c >> 8, k.t[(xor(c, b) & 255) + 1]))"
    return f"xor({steps}, 4294967295)"


VARIANTS_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
    r AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
        WHERE length(w) >= 6 GROUP BY ALL),
    h AS (SELECT w, n, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || w")} AS h FROM r, k),
    c AS (SELECT CASE WHEN h % 199 = 0 THEN w[1 : h % length(w)] || w[h % length(w) + 2 :] ELSE w END AS word, n FROM h),
    v AS (SELECT word, sum(n)::BIGINT AS n FROM c WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    d AS (SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS g FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
    p AS (SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM d a JOIN d b ON a.i = b.i AND a.g = b.g AND a.word <> b.word
        UNION SELECT DISTINCT d.word, v.word, v.n FROM d JOIN v ON d.g = v.word
        UNION SELECT DISTINCT v.word, d.word, d.n FROM d JOIN v ON d.g = v.word),
    b AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(other, (-m, other)) AS other FROM p GROUP BY word),
    f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * v.n THEN other END AS form,
            CASE WHEN m >= 5 * v.n THEN m END AS form_n FROM v LEFT JOIN b USING (word)),
    t AS (SELECT word, coalesce(form, word) AS at FROM f UNION SELECT t.word, f.form FROM t JOIN f ON t.at = f.word WHERE f.form IS NOT NULL),
    z AS (SELECT t.word, t.at AS root FROM t JOIN f ON t.at = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, z.root, f.n, f.n_near, f.form_n FROM f JOIN z USING (word)
"""


@query("op11_spelling_variants", VARIANTS_SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(common.read(spark, sf_dir, "documents"))


TRIE_SQL = rf"""
WITH {CRC_TABLE},
    o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, {_crc("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), k),
    s AS (SELECT c.conv_id, 0 AS part, o.p, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.p <= c.h
        UNION ALL SELECT c.conv_id, 1, o.p, o.role, o.text FROM c JOIN o USING (conv_id) WHERE o.p > c.h),
    r AS (SELECT conv_id, text, row_number() OVER w AS d, sha256(string_agg(sha256(role || chr(1) || text), ',') OVER w) AS id,
            len(regexp_extract_all(text, '[^ 	-
]+')) AS words FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)),
    m AS (SELECT conv_id, d, id, words FROM r UNION ALL SELECT conv_id, 0, '', 0 FROM c),
    e AS (SELECT conv_id, max(d) AS last FROM m GROUP BY conv_id),
    n AS (SELECT id, any_value(d) AS depth, min(conv_id) AS conv, count(*) AS n_convs, any_value(words) AS words,
            string_agg(CASE WHEN d = last THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends FROM m JOIN e USING (conv_id) GROUP BY id),
    x AS (SELECT n.id, p.id AS parent, p.conv AS parent_conv FROM n LEFT JOIN (SELECT a.id AS child, b.* FROM n a JOIN m ON m.conv_id = a.conv
            AND m.d = a.depth - 1 JOIN n b ON b.id = m.id) p ON p.child = n.id),
    g AS (SELECT parent AS id, count(*) AS n_children FROM x WHERE parent IS NOT NULL GROUP BY parent),
    u AS (SELECT m.id, sum(CASE WHEN g.id IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
        FROM n LEFT JOIN g USING (id) JOIN m ON m.conv_id = n.conv AND m.d <= n.depth GROUP BY m.id)
SELECT n.conv AS conv_id, n.depth::BIGINT AS depth, x.parent_conv AS parent_conv_id, n.n_convs, coalesce(g.n_children, 0) AS n_children,
    u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN x USING (id) JOIN u USING (id) LEFT JOIN g USING (id)
"""


@query("op12_prefix_trie", TRIE_SQL)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(common.read(spark, sf_dir, "conversations"))


@query("op13_token_files")
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{common.scratch_folder(spark)}/token-files"
    token_files.write_token_files(common.read(spark, sf_dir, "documents"), folder)
    return token_files.read_documents(spark, folder)
