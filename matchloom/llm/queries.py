"""One query for each operator of this folder, over its whole table and with production parameters."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import op1_warc as warc
from matchloom.llm import op2_edit_embedding as embedding
from matchloom.llm import op3_templates as templates
from matchloom.llm import op4_decontamination as decontamination
from matchloom.llm import op5_shuffle as shuffle
from matchloom.llm import op6_packing as packing
from matchloom.llm import op7_sanitise as sanitise
from matchloom.llm import op8_token_counts as token_counts
from matchloom.llm import op9_toxicity as toxicity
from matchloom.llm import op10_minhash as minhash
from matchloom.llm import op11_divide_skip as divide_skip
from matchloom.llm import op12_spelling as spelling
from matchloom.llm import op13_ranked_search as ranked_search

TOKEN_LIMIT = 4096
#: Pages have no capture time: page n counts as captured n seconds after this one.
FIRST_CAPTURE = 1_577_836_800


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("time", F.lit(FIRST_CAPTURE) + F.col("page_id"))
    return warc.capture_history(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.fingerprints(table(spark, sf_dir, "documents"))


def op3_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.main_texts(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle.placement(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    ranks, exact = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json"))
    return packing.packed(docs, ranks, public_tokenizers.PATTERN, exact)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op7_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.digest(sanitise.with_spans(table(spark, sf_dir, "documents")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), TOKEN_LIMIT)


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Grades of the labels: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    labels = table(spark, sf_dir, "labels").withColumn("grade", F.col("toxic") * (2 - F.coalesce("quality", F.lit(1))))
    return toxicity.fit(*toxicity.sample(table(spark, sf_dir, "documents"), labels))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op11_divide_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divide_skip.joined(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_edit_embedding, op3_templates, op4_decontamination, op5_shuffle, op6_packing, op7_sanitise, op8_token_counts, op9_toxicity,
        op10_minhash, op11_divide_skip, op12_spelling, op13_ranked_search,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op1_warc": """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id = page_id THEN NULL ELSE first_id END AS refers_to
FROM f
""",
    "op4_decontamination": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bi AS (
  SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item_id, m, array_to_string(w[i : i + m - 1], ' ') AS g FROM bi
), di AS (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m
), dw AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS g FROM di
), hit AS (
  SELECT doc_id, item_id, m, i FROM dw JOIN bw USING (m, g)
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, m, i FROM hit)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op10_minhash": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
""",
    "op11_divide_skip": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
), l AS (
  SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links FROM c LEFT JOIN n USING (doc_id) LEFT JOIN l USING (doc_id)
""",
    # crc32 byte by byte: a table made by its rule, then one step for each byte
    "op12_spelling": rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
    FROM (SELECT unnest(range(256)) AS i)
  )
), r AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT CAST(doc_id AS VARCHAR) AS id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
  ) GROUP BY id, run
), bytes AS (
  SELECT run, times, list_transform(range(CAST(len(x) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)) AS b
  FROM (SELECT run, times, hex(encode(id || ':' || run)) AS x FROM r)
), h AS (
  SELECT run, times, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1]))) AS h FROM bytes, crc_table
), v AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM h
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), less AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS w FROM (SELECT word, unnest(range(length(word))) AS i FROM v)
), pairs AS (
  SELECT less.word AS a, v.word AS b FROM less JOIN v ON less.w = v.word
  UNION SELECT v.word, less.word FROM less JOIN v ON less.w = v.word
  UNION SELECT x.word, y.word FROM less x JOIN less y ON x.w = y.w AND x.i = y.i AND x.word <> y.word
), best AS (
  SELECT a, count(*) AS n_near, arg_min(b, (-v.n, b)) AS form, max(v.n) AS form_n FROM pairs JOIN v ON v.word = b GROUP BY a
), f AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM v LEFT JOIN best ON a = word
), up AS (
  SELECT word, form AS root, 1 AS depth FROM f WHERE form IS NOT NULL
  UNION ALL SELECT up.word, f.form, depth + 1 FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(root, depth) AS root FROM up GROUP BY word
)
SELECT word, n, n_near, form, form_n, coalesce(root, word) AS root FROM f LEFT JOIN roots USING (word)
""",
    "op13_ranked_search": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
  ) GROUP BY item_id, term
), size AS (
  SELECT count(*) FILTER (len(t) > 0) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d
), tf AS (
  SELECT doc_id, 25 + (75 * any_value(len(t)) * any_value(size.n)) // any_value(size.l) AS m, term, count(*) AS tf
  FROM (SELECT doc_id, t, unnest(t) AS term FROM d), size GROUP BY doc_id, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, size GROUP BY term
), s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0
) WHERE rank <= 10
""",
}
