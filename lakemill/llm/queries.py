"""The registered queries of this package: thin digests of the operators' results, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm import codes, decontaminate, licenses, packing, quality, search, simhash, suffixes, token_files, toxicity, vectors, warc, windows
from lakemill.llm.common import fold
from lakemill.session import settle, tune

TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"
POSITIVE = 0.3


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"), width=4, distance=4)


def _scored(spark: SparkSession, folder: str, module, label: str, parts: int, held: int) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").select("doc_id", label)
    some = quality.with_labels(docs, labels, label, fold("doc_id", parts) != held, settings=module.Settings())
    model = module.fit(some, label=label)
    scored = quality.score(docs, model).select("doc_id", "score")
    return scored.select(
        "doc_id", (fold("doc_id", parts) == held).alias("held_out"), "score", (F.col("score") >= POSITIVE).cast("int").alias("predicted")
    )


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, quality, "quality", 5, 0)


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.find_notices(_table(spark, folder, "documents"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    stored = token_files.write(docs, tokenizer_path(), unnamed=True)
    return token_files.read(spark, stored).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_passages(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op6_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, folder, "embeddings"))


def op7_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.remove_repeats(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder, toxicity, "toxic", 4, 2)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    found = packing.pieces(_table(spark, folder, "documents"), tokenizer_path())
    digests = settle(found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return packing.place(digests)


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = warc.write(_table(spark, folder, "pages"))
    records, _ = warc.read(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_codes(spark: SparkSession, folder: str) -> DataFrame:
    found = codes.encode(_table(spark, folder, "embeddings"))
    columns = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if found is None:
        return spark.createDataFrame([], columns)
    rows = found.rows
    totals = rows.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    joined = rows.join(totals, F.col("label").eqNullSafe(F.col("l")))
    return joined.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", F.lit(found.books.digest()).alias("codebooks_sha256"))


def op12_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_windows(spark: SparkSession, folder: str) -> DataFrame:
    found = windows.pack(_table(spark, folder, "documents"), tokenizer_path(WORD_TOKENIZER))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _license_sql() -> str:
    """Units, sets of bigrams and the coefficient, written in SQL."""
    quoted = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(licenses.TEMPLATES.items()))
    words = r"list_filter(string_split_regex(lower({0}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
    pairs = "CASE WHEN len({0}) > 1 THEN list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1])) ELSE [] END"
    return f"""
    WITH body AS (SELECT doc_id, replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM documents),
    lines AS (SELECT doc_id, 'line' AS kind, unnest(range(len(string_split(t, chr(10))))) AS unit, unnest(string_split(t, chr(10))) AS u FROM body),
    blocks AS (
      SELECT doc_id, 'block' AS kind, unnest(range(len(string_split_regex(t, '\\n[ \\t]*\\n\\s*')))) AS unit,
        unnest(string_split_regex(t, '\\n[ \\t]*\\n\\s*')) AS u FROM body),
    units AS (SELECT * FROM lines UNION ALL SELECT * FROM blocks WHERE contains(trim(u, ' '), chr(10))),
    worded AS (SELECT doc_id, kind, unit, {words.format("u")} AS w FROM units),
    sized AS (SELECT doc_id, kind, unit, {pairs.format("w")} AS b FROM worded),
    known AS (SELECT license, {words.format("t")} AS w FROM (VALUES {quoted}) v(license, t)),
    patterns AS (SELECT license, {pairs.format("w")} AS p FROM known)
    SELECT doc_id, kind, CAST(unit AS BIGINT) AS unit, license, 2 * len(list_intersect(b, p)) / (len(b) + len(p)) AS similarity
    FROM sized, patterns
    WHERE len(b) BETWEEN len(p) / 2 AND 2 * len(p) AND 2 * len(list_intersect(b, p)) >= {licenses.THRESHOLD} * (len(b) + len(p))
    """


VECTOR_SQL = """
    WITH RECURSIVE v AS (
      SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(l.b, e.vec_id)) AS component_id,
      e.vec_id = least(e.vec_id, coalesce(l.b, e.vec_id)) AS kept
    FROM embeddings e LEFT JOIN least l ON l.a = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id
    """

SUFFIX_SQL = """
    WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
    places AS (SELECT doc_id, h, unnest(range(CAST(len(h) / 2 - 49 AS BIGINT))) AS pos FROM d WHERE len(h) >= 100),
    windows AS (SELECT doc_id, pos, md5_number(substr(h, 2 * pos + 1, 100)) AS w FROM places),
    least AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
    gone AS (SELECT doc_id, pos FROM windows JOIN least USING (w) WHERE doc_id > first),
    edges AS (SELECT doc_id, pos, CASE WHEN pos - lag(pos) OVER o <= 50 THEN 0 ELSE 1 END AS new FROM gone WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
    spans AS (
      SELECT doc_id, min(pos) AS lo, max(pos) + 50 AS hi
      FROM (SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM edges) GROUP BY doc_id, span),
    gaps AS (
      SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM spans),
    cut AS (
      SELECT g.doc_id, sum(hi - lo) AS n, count(*) AS spans, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS kept, max(hi) AS last
      FROM gaps g JOIN d USING (doc_id) GROUP BY g.doc_id)
    SELECT d.doc_id, CAST(len(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
      sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN cut USING (doc_id)
    """

WARC_SQL = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
    digest AS (SELECT page_id, t, sha1(t) AS s FROM p),
    first AS (SELECT t, min(page_id) AS least FROM p GROUP BY t),
    quints AS (
      SELECT page_id, unnest(range(32)) AS k, s FROM digest),
    letters AS (
      SELECT page_id, k,
        list_sum(list_transform(range(5), lambda j: CASE WHEN (CAST(('0x' || substr(s, (5 * k + j) // 4 + 1, 1)) AS INTEGER) >> (3 - (5 * k + j) % 4)) & 1 = 1
          THEN CAST(1 << (4 - j) AS INTEGER) ELSE 0 END)) AS v FROM quints),
    spelled AS (SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v AS INTEGER) + 1, 1), '' ORDER BY k) AS b FROM letters GROUP BY page_id)
    SELECT d.page_id, CAST(strlen(d.t) AS BIGINT) AS payload_bytes, b AS payload_digest,
      CASE WHEN d.page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN d.page_id = least THEN NULL ELSE least END AS refers_to
    FROM digest d JOIN first USING (t) JOIN spelled USING (page_id)
    """


def _codes_sql() -> str:
    """Four rounds of assignment and means, one after the other, on lists of whole numbers in doubles."""

    def nearest(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
          SELECT vec_id, label, p, x, min_by(entry, (d, entry)) AS entry, min(d) AS d FROM (
            SELECT v.*, b.entry, list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, b.x) + list_dot_product(b.x, b.x) AS d
            FROM parts v JOIN b{k} b USING (p)) GROUP BY vec_id, label, p, x)"""

    def means(k: int) -> str:
        return f"""m{k} AS (
          SELECT p, entry, list(m ORDER BY i) AS x FROM (
            SELECT p, entry, i, floor(sum(x[i + 1]) / count(*)) AS m FROM a{k}, (SELECT unnest(range((SELECT any_value(len(x)) FROM parts))) AS i)
            GROUP BY p, entry, i) GROUP BY p, entry),
        b{k + 1} AS MATERIALIZED (SELECT p, entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m USING (p, entry))"""

    rounds = ", ".join(f"{nearest(k)}, {means(k)}" for k in range(codes.ROUNDS))
    return f"""
    WITH v AS (
      SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor({codes.SCALE} * x)) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
      SELECT vec_id, label, p, e[p * len(e) // {codes.PARTS} + 1 : (p + 1) * len(e) // {codes.PARTS}] AS x
      FROM v, (SELECT unnest(range({codes.PARTS})) AS p)),
    seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT {codes.ENTRIES}),
    b0 AS MATERIALIZED (SELECT p, entry, x FROM seeds JOIN parts USING (vec_id)),
    {rounds}, {nearest(codes.ROUNDS)},
    digest AS (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, entry, i)) AS h FROM (
      SELECT p, entry, unnest(x) AS c, unnest(range(len(x))) AS i FROM b{codes.ROUNDS})),
    coded AS (
      SELECT vec_id, label, string_agg(lower(printf('%02x', entry)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM a{codes.ROUNDS} GROUP BY vec_id, label)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded, digest
    """


SEARCH_SQL = r"""
    WITH signs AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS term),
    d AS (SELECT doc_id, regexp_extract_all(translate(text, upper, lower), term) AS w FROM documents, signs WHERE text IS NOT NULL),
    facts AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
    asked AS (
      SELECT item_id, t, count(*) AS q
      FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, upper, lower), term)) AS t FROM benchmark, signs) GROUP BY item_id, t),
    held AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, n, t),
    weight AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, facts GROUP BY t),
    own AS (
      SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))) AS s
      FROM held JOIN weight USING (t), facts),
    scored AS (SELECT item_id, doc_id, CAST(sum(q * s) AS BIGINT) AS score FROM asked JOIN own USING (t) GROUP BY item_id, doc_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """


def queries() -> dict:
    return {
        "op1_simhash": op1_simhash,
        "op2_quality": op2_quality,
        "op3_licenses": op3_licenses,
        "op4_token_files": op4_token_files,
        "op5_decontaminate": op5_decontaminate,
        "op6_vectors": op6_vectors,
        "op7_suffixes": op7_suffixes,
        "op8_toxicity": op8_toxicity,
        "op9_packing": op9_packing,
        "op10_warc": op10_warc,
        "op11_codes": op11_codes,
        "op12_search": op12_search,
        "op13_windows": op13_windows,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_licenses": _license_sql(),
        "op6_vectors": VECTOR_SQL,
        "op7_suffixes": SUFFIX_SQL,
        "op10_warc": WARC_SQL,
        "op11_codes": _codes_sql(),
        "op12_search": SEARCH_SQL,
    }
