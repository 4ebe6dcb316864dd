"""Queries that apply each operator to its whole table, with the SQL that says the same where there is one."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relstream.llm import (
    chunks, compression, decontamination, fuzzylines, hilbert, lattice, minhash, packing, periodicity, repetition, spellings, tagpaths, toxicity,
)

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[name] = Query(build, sql)
        return build
    return register


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def tokenizer_path() -> str:
    """The byte-level vocabulary; RELSTREAM_TOKENIZER names another place."""
    if named := os.environ.get("RELSTREAM_TOKENIZER"):
        return named
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_tag_path_text")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return tagpaths.extract(read(spark, folder, "pages").select("page_id", "url", "html"))


@query("op2_compression_quality")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return compression.rate(read(spark, folder, "documents"), read(spark, folder, "labels"), threshold=0.3)


@query("op3_benchmark_matches")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.with_matches(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "benchmark"))
    return found.select("doc_id", F.inline("matches"))


@query("op4_toxic_clauses")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.rate(read(spark, folder, "documents"), read(spark, folder, "labels"), threshold=0.5)


@query("op5_fuzzy_lines")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzylines.dedup_lines(read(spark, folder, "documents").select("doc_id", "text"))


#: All pairs of documents that share a shingle, exactly, and what links reach.
CLASSES = """
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws]
                                         ELSE [ws[i:i + 4] FOR i IN range(1, len(ws) - 3)] END) AS shingle FROM w),
    n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b USING (shingle)
               WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
    links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
              WHERE 100 * common >= 75 * (x.size + y.size - common)),
    reach AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION
              SELECT id, b FROM reach JOIN links ON other = a),
    least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
    SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM documents JOIN least ON id = doc_id LEFT JOIN n USING (doc_id)"""


@query("op6_minhash_classes", CLASSES)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, folder, "documents").select("doc_id", "text"))


@query("op7_hilbert_shards")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    rows = docs.select("doc_id", "lang", "source", size.alias("size"),
                       F.crc32(F.coalesce(F.encode("text", "utf-8"), F.lit(b""))).alias("text_crc32"))
    sharded = hilbert.shard_by_curve(rows, ["lang", "source", "size"], ["doc_id", "text_crc32"], shards=16)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"), "curve")


_RULES = repetition.RepetitionRules()


def _repetition_sql() -> str:
    """Windows of each length as joined words, counted per document; the words under those that occur twice."""
    lengths = sorted({8, *_RULES.ngrams})
    parts = ",\n".join(f"""
      g{n} AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, hash(ws[i:i + {n - 1}])) > 1 AS twice
               FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n} + 2)) AS i FROM w)),
      s{n} AS (SELECT doc_id, i, max(CASE WHEN twice THEN i END) OVER (PARTITION BY doc_id ORDER BY i
                 RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS covering
               FROM (SELECT doc_id, i, twice FROM g{n} UNION ALL
                     SELECT doc_id, unnest(range(greatest(len(ws) - {n} + 2, 1), len(ws) + 1)), false FROM w)),
      c{n} AS (SELECT s.doc_id, count(*) AS words, sum(length(ws[s.i])) AS chars FROM s{n} s JOIN w USING (doc_id)
               WHERE covering IS NOT NULL GROUP BY s.doc_id)""" for n in lengths)
    within = " AND ".join(f"100 * dup{n}_chars <= {limit} * word_chars" for n, limit in _RULES.ngrams.items())
    return f"""
    WITH w AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
      l AS (SELECT doc_id, count(*) AS n_dup_lines, sum(chars) AS chars
            FROM (SELECT doc_id, line, i, list_sum(list_transform(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'), lambda x: length(x))) AS chars,
                         row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS k
                  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                               unnest(range(len(string_split(text, chr(10))))) AS i FROM w))
            WHERE k > 1 AND chars > 0 GROUP BY doc_id),{parts},
      m AS (SELECT doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
              CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
              coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(c8.words, 0) AS n_repeat_words,
              CAST(coalesce(l.chars, 0) AS BIGINT) AS dup_line_chars,
              {", ".join(f"CAST(coalesce(c{n}.chars, 0) AS BIGINT) AS dup{n}_chars" for n in _RULES.ngrams)}
            FROM w LEFT JOIN l USING (doc_id) {" ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in lengths)}),
      b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
    SELECT *, NOT base_failed AND 100 * dup_line_chars <= {_RULES.line_chars} * word_chars AND {within} AS kept FROM b"""


@query("op8_repetition_coverage", _repetition_sql())
def op8(spark: SparkSession, folder: str) -> DataFrame:
    rated = repetition.repetition_rules(read(spark, folder, "documents").select("doc_id", "text"), _RULES)
    return rated.drop("text")


@query("op9_repeated_passages")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.repeated_passages(read(spark, folder, "documents").select("doc_id", "text"))


@query("op10_packed_sequences")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), tokenizer_path(), length=1024, end=0).drop("ids")


#: crc32 in SQL: a table of 256 remainders, made from the polynomial, and a fold over the bytes of a text.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc(text: str) -> str:
    bytes_ = f"list_transform(range(octet_length(encode({text}))), lambda k: CAST('0x' || substr(hex(encode({text})), 2 * k + 1, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295)"


_RUNS = f"""
    WITH {_CRC_TABLE},
    d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws, {_crc("CAST(doc_id AS VARCHAR)")} AS h
          FROM documents, crc),
    a AS (SELECT doc_id, ws, len(ws) AS n, h, h // 10 AS g, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM d),
    p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
    w AS (SELECT doc_id, n, i, ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word
          FROM (SELECT *, unnest(range(n)) AS i FROM p)),
    same AS (SELECT x.doc_id, x.i - y.i AS lag, x.i FROM w x JOIN w y USING (doc_id, word) WHERE y.i < x.i AND 4 * (x.i - y.i) <= x.n),
    grown AS (SELECT doc_id, lag, min(i) - lag AS start, count(*) + lag AS length
              FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM same)
              GROUP BY doc_id, lag, island HAVING count(*) + lag >= greatest(6, 4 * lag)),
    runs AS (SELECT doc_id, start, length, lag AS period FROM grown r WHERE NOT EXISTS (
               SELECT 1 FROM grown s WHERE s.doc_id = r.doc_id AND s.lag < r.lag AND s.start <= r.start AND s.start + s.length >= r.start + r.length)),
    best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS k FROM runs),
    told AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
             FROM runs GROUP BY doc_id),
    lean AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM w WHERE NOT EXISTS (
               SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
           sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM documents LEFT JOIN told USING (doc_id) LEFT JOIN lean USING (doc_id)
    LEFT JOIN best b ON b.doc_id = documents.doc_id AND k = 1"""


@query("op11_periodic_runs", _RUNS)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    # The contract's planted runs; rows without a doc_id stay as they are.
    planted = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary"))) \
        .withColumn("ws", F.when(F.col("h") % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))) \
        .withColumn("n", F.size("ws")).withColumn("g", F.expr("h div 10")) \
        .withColumn("a", F.when(F.col("n") > 0, F.expr("g % n"))).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0, n - 1), i -> ws[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    found = periodicity.periodic_runs(planted.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"), F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


_FORMS = f"""
    WITH RECURSIVE {_CRC_TABLE},
    r AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
    c AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 6 GROUP BY doc_id, run),
    h AS (SELECT run, n, {_crc("doc_id || ':' || run")} AS h FROM c, crc),
    w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
            SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
                        ELSE run END AS word, n FROM h)
          WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    g AS (SELECT word, n, unnest(range(length(word))) AS i FROM w),
    k AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS less, left(word, i) || '*' || substr(word, i + 2) AS other FROM g),
    near AS (SELECT x.word AS a, y.word AS b FROM k x JOIN k y USING (other) WHERE x.word <> y.word
             UNION SELECT word, less FROM k WHERE less IN (SELECT word FROM w)
             UNION SELECT less, word FROM k WHERE less IN (SELECT word FROM w)),
    best AS (SELECT a, b, n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS k
             FROM near JOIN w ON b = word),
    f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 5 * w.n THEN b END AS form,
                 CASE WHEN best.n >= 5 * w.n THEN best.n END AS form_n FROM w LEFT JOIN best ON a = w.word AND k = 1),
    way AS (SELECT word, word AS here FROM f UNION ALL SELECT way.word, form FROM way JOIN f ON f.word = here WHERE form IS NOT NULL)
    SELECT f.word, form, here AS root, n, n_near, form_n FROM f JOIN way USING (word) WHERE here IN (SELECT word FROM f WHERE form IS NULL)"""


@query("op12_spelling_variants", _FORMS)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return spellings.spellings(read(spark, folder, "documents").select("doc_id", "text"), misspell=True)


_COSINES = """
    WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
              WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
              WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
    reach AS (SELECT vec_id AS id, vec_id AS other FROM embeddings UNION SELECT id, b FROM reach JOIN links ON other = a),
    least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
    n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN least ON id = vec_id LEFT JOIN n ON a = vec_id"""


@query("op13_lattice_neighbours", _COSINES)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_duplicates(read(spark, folder, "embeddings").select("vec_id", "embedding", "label"))
