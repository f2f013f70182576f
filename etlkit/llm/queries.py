"""Registered queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from etlkit.llm.common import table
from etlkit.llm.decontaminate import find_leaks
from etlkit.llm.divergence import audit_divergence
from etlkit.llm.language import identify_documents, identify_pages, train
from etlkit.llm.line_dedup import drop_repeated_lines
from etlkit.llm.ngram_join import near_groups
from etlkit.llm.packing import pack
from etlkit.llm.passages import remove_repeated_passages
from etlkit.llm.quality import score_quality
from etlkit.llm.runs import collapse_runs
from etlkit.llm.sharding import shard_by_bytes
from etlkit.llm.suffix_dedup import remove_repeated_strings
from etlkit.llm.vector_join import link_vectors
from etlkit.llm.warc import round_trip
from etlkit.session import drop_scratch, scratch_path

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f
    return keep


SHARDS = 40


@query()
def op6_histogram_sharding(spark, folder):
    return shard_by_bytes(table(spark, folder, "documents"), SHARDS)


@query()
def op3_quality_classifier(spark, folder):
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op10_best_fit_packing(spark, folder):
    return pack(table(spark, folder, "documents"))


@query()
def op9_ngram_jaccard_join(spark, folder):
    return near_groups(table(spark, folder, "documents"))


@query()
def op1_embedding_near_dedup(spark, folder):
    return link_vectors(table(spark, folder, "embeddings"))


@query("""WITH l AS (SELECT doc_id, i - 1 AS pos, string_split(text, chr(10))[i] AS line
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
  u AS (SELECT line, min(doc_id * 1000000 + pos) AS o, length(line) AS n FROM l WHERE trim(line, ' ') <> '' GROUP BY line),
  v AS (SELECT o, n, i, left(line, i - 1) || substr(line, i + 1) AS cut FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM u WHERE n >= 16)),
  same AS (SELECT v.o FROM v JOIN (SELECT n, i, cut, min(o) AS first FROM v GROUP BY ALL) USING (n, i, cut) WHERE first < v.o),
  less AS (SELECT v.o AS long, u.o AS short FROM v JOIN u ON u.line = v.cut WHERE u.n >= 16),
  gone AS (SELECT o FROM same UNION SELECT long FROM less WHERE short < long UNION SELECT short FROM less WHERE long < short)
SELECT doc_id, count(*)::INTEGER AS n_lines, count(*) FILTER (NOT keep)::INTEGER AS n_removed,
  md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keep), '')) AS kept_md5
FROM (SELECT l.doc_id, l.pos, l.line, trim(l.line, ' ') = '' OR (u.o = l.doc_id * 1000000 + l.pos AND gone.o IS NULL) AS keep
      FROM l LEFT JOIN u ON u.line = l.line LEFT JOIN gone ON gone.o = u.o) GROUP BY doc_id""")
def op4_line_dedup(spark, folder):
    kept = drop_repeated_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("kept_md5"))


@query()
def op2_language_id(spark, folder):
    """Documents (page_id NULL) and pages (doc_id NULL), by one model."""
    docs = table(spark, folder, "documents")
    languages, model = train(docs)
    found = identify_documents(docs, languages, model).withColumn("page_id", F.lit(None).cast("long"))
    return found.unionByName(identify_pages(table(spark, folder, "pages"), languages, model).withColumn("doc_id", F.lit(None).cast("long")))


@query()
def op5_benchmark_decontamination(spark, folder):
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op8_suffix_array_dedup(spark, folder):
    return remove_repeated_strings(table(spark, folder, "documents")).drop("text")


@query()
def op7_substring_dedup(spark, folder):
    return remove_repeated_passages(table(spark, folder, "documents")).drop("text")


@query("""SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN revisit THEN last END AS refers_to
FROM (SELECT *, strlen(h) >= 1000 AND page_id < last AS revisit
      FROM (SELECT page_id, h, max(page_id) OVER (PARTITION BY h) AS last FROM (SELECT page_id, coalesce(html, '') AS h FROM pages)))""")
def op11_warc_round_trip(spark, folder):
    archives = scratch_path(spark, "warc")
    records = round_trip(table(spark, folder, "pages"), archives)
    drop_scratch(spark, archives)  # the records are written down
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def planted_repeats(docs):
    """doc_id and text; a tenth of the documents, told by the CRC of the id, repeat their words from some place on. NULL ids do not."""
    h = docs.select("doc_id", "text", F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY))").alias("h"))
    chosen = h.where("h % 10 = 0").withColumn("w", F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x <> '')"))
    sized = chosen.withColumns({"n": F.expr("CAST(greatest(coalesce(size(w), 0), 0) AS BIGINT)"), "g": F.expr("h div 10")})
    placed = sized.withColumn("a", F.expr("g % greatest(n, 1L)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(slice(concat(slice(w, 1, int(a)), flatten(array_repeat(slice(w, int(a) + 1, int(p)), int((n - a) div p + 1)))), 1, int(n)), ' ')")
    return h.where("h % 10 <> 0 OR h IS NULL").select("doc_id", "text").unionByName(placed.select("doc_id", F.when(F.col("n") > 0, repeated).alias("text")))


@query()
def op12_periodic_runs(spark, folder):
    found = collapse_runs(planted_repeats(table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("early"), (-r["period"]).alias("short"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("m"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))
    return told.selectExpr("doc_id", "n_runs", "-m.early AS start", "m.length AS length", "-m.short AS period", "1000 * m.length div -m.short AS exponent_milli",
                           "runs_sha256", "collapsed_sha256")


@query(r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
  w AS (SELECT doc_id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM d),
  k AS (SELECT lang, t FROM w GROUP BY lang, t HAVING count(DISTINCT doc_id) >= 3),
  c AS (SELECT lang, source, t, count(*) AS n FROM w GROUP BY lang, source, t),
  g AS (SELECT DISTINCT lang, source FROM d),
  x AS (SELECT g.lang, g.source, k.t, coalesce(c.n, 0) AS n FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.t = k.t),
  s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, count(*) OVER (PARTITION BY lang, source) AS v,
          sum(n) OVER (PARTITION BY lang, t) AS lang_n, sum(n) OVER (PARTITION BY lang) AS lang_total FROM x),
  p AS (SELECT lang, source, t, n, (1 + 1000000000 * (n + 1) // (total + v))::BIGINT AS p, (1 + 1000000000 * (lang_n + 1) // (lang_total + v))::BIGINT AS q FROM s),
  f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
  r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
        UNION ALL SELECT lang, source, 'term', t, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
  o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT * FROM o WHERE part = 'pair' OR rank <= 200""")
def op13_source_divergence_audit(spark, folder):
    return audit_divergence(table(spark, folder, "documents"))
