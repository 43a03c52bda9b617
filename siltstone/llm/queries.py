"""One registered query per corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import (
    ann,
    collocations,
    cotrain,
    decontaminate,
    licenses,
    lm,
    packing,
    prefix_counts,
    ranked,
    records,
    toxicity,
    warc,
)
from siltstone.llm.fitting import remainder
from siltstone.llm.near_dup import near_duplicates
from siltstone.llm.shipping import ship
from siltstone.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return run

    return add


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query("op3_token_records")
def token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written as framed records in id order, and read back."""
    folder = scratch_path(spark, "records")
    records.write_records(
        load(spark, sf_dir, "documents"),
        folder,
        public_tokenizers.path("byte_bpe_50k.json"),
        end_id=2,
    )
    return records.read_records(spark, folder)


@query("op6_packing")
def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids."""
    return packing.pack(
        load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )


@query("op8_prefix_counts")
def prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every text, and how much of it fits 512 tokens."""
    counted = prefix_counts.prefix_token_counts(
        load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), budget=512
    )
    return counted.select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > 512).alias("over_limit"),
        "prefix_chars",
    )


_ALNUM_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DECONTAMINATION_SQL = rf"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER_SQL}, '{_ALNUM_SQL}'), []) AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all({_LOWER_SQL}, '{_ALNUM_SQL}') AS w
  FROM benchmark WHERE text IS NOT NULL
), patterns AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, w[i : i + least(len(w), 10) - 1] AS p
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bw WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT m FROM patterns),
spots AS (
  SELECT doc_id, m, i, w[i : i + m - 1] AS p
  FROM (SELECT doc_id, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM dw, lengths
        WHERE len(w) >= m)
), found AS (
  SELECT doc_id, i, s.m, item_id FROM spots s JOIN patterns b ON s.m = b.m AND s.p = b.p
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op4_decontamination", _DECONTAMINATION_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in every document."""
    found = decontaminate.benchmark_hits(
        load(spark, sf_dir, "documents").select("doc_id", "text"),
        load(spark, sf_dir, "benchmark"),
        window=10,
    )
    marks = F.hex("hit_words")  # "01" for a hit word, "00" for another
    n_hit = F.length(marks) - F.length(F.replace(marks, F.lit("1"), F.lit("")))
    return found.select(
        "doc_id",
        "n_words",
        F.coalesce(n_hit.cast("bigint"), F.lit(0).cast("bigint")).alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        F.col("hit_words").isNotNull().alias("contaminated"),
    )


_NEAR_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER_SQL}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, w[i : i + least(len(w), 4) - 1] AS g
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 4) + 2)) AS i FROM w WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM met JOIN size x ON a = x.doc_id JOIN size y ON b = y.doc_id
  WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
), side AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, side.b FROM reach r JOIN side ON r.other = side.a
), least_one AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_one LEFT JOIN size USING (doc_id)
"""


@query("op2_near_dup", _NEAR_SQL)
def near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose four-word shingle sets are alike by 0.8."""
    found = near_duplicates(load(spark, sf_dir, "documents"), shingle=4, per_cent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op5_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from the rows that are not held out."""
    docs = load(spark, sf_dir, "documents")
    rest = remainder("doc_id", 3)
    net = toxicity.fit(docs, load(spark, sf_dir, "labels"), learn_from=rest != 1)
    scored = toxicity.with_toxicity(docs.select("doc_id", "lang", "text"), net)
    return scored.select(
        "doc_id",
        (rest == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        toxicity.over_threshold(net, F.col("score"), F.col("lang")).alias("over_threshold"),
    )


@query("op9_cotrained_quality")
def cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by its content, its metadata and both."""
    docs = load(spark, sf_dir, "documents")
    judge = cotrain.fit(docs, load(spark, sf_dir, "labels"))
    return cotrain.with_quality(docs, judge).select(
        "doc_id", "content_score", "metadata_score", "quality_score", "good"
    )


@query("op7_lm_scores")
def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's log10 chance by word counts and by the mixed attention model."""
    return lm.score_texts(
        load(spark, sf_dir, "documents"),
        held_out=remainder("doc_id", 10) == 0,
        tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
    )


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS original FROM p),
d AS (
  SELECT page_id, strlen(html) AS payload_bytes, original,
         list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(list_transform(range(0, 5),
             lambda b: CAST(substr(bits, 5 * i + b + 1, 1) AS INTEGER) * CAST(2 ** (4 - b) AS INTEGER))) AS BIGINT), 1)) AS letters
  FROM (SELECT *, array_to_string(list_transform(range(1, 41), lambda j:
          substr('0000000100100011010001010110011110001001101010111100110111101111',
                 4 * instr('0123456789abcdef', substr(sha1(html), j, 1)) - 3, 4)), '') AS bits FROM k)
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(letters, '') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM d
"""


@query("op10_warc", _WARC_SQL)
def warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page converted from ARC to WARC and read back."""
    found = warc.archive(load(spark, sf_dir, "pages"), least_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op1_nearest")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest vectors of every hundredth id, found in shard graphs."""
    vectors = load(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


_RANKED_SQL = rf"""
WITH words AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({_LOWER_SQL}, '{_ALNUM_SQL}') AS w
  FROM documents WHERE text IS NOT NULL
), sized AS (SELECT d, doc_id, len(w) AS n FROM words WHERE len(w) > 0),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized),
tf AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM words) GROUP BY d, term
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, totals
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER_SQL}, '{_ALNUM_SQL}')) AS term
  FROM benchmark WHERE text IS NOT NULL
), scored AS (
  SELECT item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) //
           (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN sized USING (d), totals
  GROUP BY item_id, d, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM scored WHERE score > 0)
WHERE rank <= 10
"""


@query("op11_ranked_search", _RANKED_SQL)
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), k=10)


_PHRASES_SQL = rf"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
          unnest(string_split_regex({_LOWER_SQL}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
sizes AS (SELECT unnest([1, 2, 3]) AS words),
f AS (
  SELECT lang, words, phrase, count(*) AS a FROM (
    SELECT lang, words, array_to_string(w[i : i + words - 1], ' ') AS phrase
    FROM (SELECT lang, w, words, unnest(range(1, len(w) - words + 2)) AS i
          FROM pieces, sizes WHERE len(w) >= words))
  GROUP BY lang, words, phrase HAVING count(*) >= 10
), cuts AS (
  SELECT lang, words, phrase, a, k, array_to_string(w[1 : k], ' ') AS head,
         array_to_string(w[k + 1 :], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, words)) AS k FROM f WHERE words > 1)
), scored AS (
  SELECT c.lang, c.words, c.phrase, c.a, c.k, x.a AS l, y.a AS r,
         CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head
       JOIN f y ON y.lang = c.lang AND y.phrase = c.tail
), least_cut AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), around AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(w[i : i + 1], ' ') AS phrase
    FROM (SELECT lang, a, string_split(phrase, ' ') AS w, unnest([1, 2]) AS i FROM f WHERE words = 3))
  GROUP BY lang, phrase
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT s.*, n, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) AS rank
  FROM least_cut s JOIN totals USING (lang) LEFT JOIN around g ON g.lang = s.lang AND g.phrase = s.phrase
  WHERE longer IS NULL OR 100 * longer < 50 * s.a)
WHERE rank <= 2000
"""


@query("op12_collocations", _PHRASES_SQL)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of two and three words of every language."""
    return collocations.collocations(load(spark, sf_dir, "documents"), least=10, top=2000)


@query("op13_license_scan")
def license_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and wordings of every document."""
    found = licenses.license_scan(load(spark, sf_dir, "documents"), keep=["doc_id"])
    labels = lambda column: F.transform(column, lambda s: s["label"])
    listed = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    starts = F.transform("base_spans", lambda s: s["start"])
    best = F.array_max(F.transform("wordings", lambda s: s["share"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_spans").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(labels("base_spans")).alias("base_labels"),
        listed(F.concat(labels("base_spans"), labels("wordings"))).alias("labels"),
        F.when(F.size("base_spans") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )
