"""Registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm import (decontam, dialogs, langid, neardup, orcids, outliers, packing, periodic, pii, quality_fm, seedextend, suffixes, tokens,
                         urllist)
from skuflow.llm.common import scratch_dir, stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontam.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise_documents(_table(spark, sf_dir, "documents"))


def op3_two_stage_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("bigint"), lambda t, s: t + s["end"] - s["first"]).alias("n_removed"),
                        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op6_ecoc_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op7_mcd_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(_table(spark, sf_dir, "documents"))


def _number(column, first: int, n: int):
    """A number from hex digits of an md5, the same in Spark and in the SQL."""
    return F.conv(F.substring(F.md5(column.cast("binary")), first, n), 16, 10).cast("bigint")


def url_entries(pages: DataFrame) -> DataFrame:
    """A dated list derived from the pages' hosts and their parent domains: adds, removes and second adds."""
    hosts = pages.select(urllist.host(F.col("url")).alias("h")).where("h is not null").distinct()
    parents = hosts.select(F.regexp_replace("h", r"^[^.]+\.", "").alias("h"))
    names = hosts.union(parents).distinct().withColumn("kind", _number(F.col("h"), 1, 4) % 4).where("kind < 2")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (_number(F.col("h"), 5, 4) % 200).cast("int"))
    held = (_number(F.col("h"), 9, 4) % 90 + 10).cast("int")
    rows = names.select(F.col("h").alias("pattern"), F.when(F.col("kind") == 0, "spam").otherwise("adult").alias("list"), F.explode(F.array(
        F.struct(F.lit("add").alias("action"), day.alias("day")),
        F.struct(F.lit("remove").alias("action"), F.date_add(day, held).alias("day")),
        F.struct(F.lit("add").alias("action"), F.date_add(day, held * 2).alias("day")))).alias("e"))
    return rows.select("pattern", "list", "e.action", "e.day")


def op8_temporal_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 366).cast("int"))
    captures = pages.select(F.col("page_id").alias("id"), "url", day.alias("day"))
    found = urllist.judge(captures, url_entries(pages))
    return found.select(F.col("id").alias("page_id"), "host", F.col("day").alias("fetched"), "blocked", "pattern", "list", "valid_from", "valid_to")


def op9_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark)}/token-ids-{uuid.uuid4().hex}"
    orcids.write(_table(spark, sf_dir, "documents"), path, tokens.vocabulary())
    return orcids.digest(spark, path)


def op10_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokens.vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = seedextend.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.aggregate("spans", F.lit(0).cast("bigint"), lambda t, s: t + s["end"] - s["first"]).alias("n_removed"),
                        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with faults, by crc32 of ``conv_id:turn``: rows lost, emptied, cut short, repeated, given to the user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    kind = F.col("kind")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("kind")).where("kind != 0")
    rows = rows.withColumn("copy", F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"))


def _digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, in the order in which the rows stream by."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = digest = None
        for batch in batches:
            ids, digests = [], []
            for conv_id, place, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 0:
                    if digest is not None:
                        ids.append(own)
                        digests.append(digest.hexdigest())
                    own, digest = conv_id, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            id_type = batch.schema.field(0).type
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(digests, pa.string())], ["conv_id", "repaired_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own], id_type), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])

    return rows.select("conv_id", "place", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def op12_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(_table(spark, sf_dir, "conversations"))


def repaired(conversations: DataFrame) -> DataFrame:
    """Every conversation, damaged, then repaired; one that lost all its rows has zeros, an empty audit and the hash of nothing."""
    rows = damaged(conversations)
    report = stage(dialogs.repair(rows), "repairs")
    digests = _digests(dialogs.repaired_rows(rows, report)).withColumnRenamed("conv_id", "d")
    report = report.withColumnRenamed("conv_id", "c")
    out = conversations.select("conv_id").distinct()
    out = out.join(report, out["conv_id"].eqNullSafe(report["c"]), "left")
    out = out.join(digests, out["conv_id"].eqNullSafe(digests["d"]), "left")
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def looped(docs: DataFrame) -> DataFrame:
    """The documents, of which a tenth (by crc32 of doc_id, null ids never) repeat their words from some word on with a period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
                split = text.split() if text and h % 10 == 0 else ()
                if split:
                    g, n = h // 10, len(split)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    text = b" ".join(split[i] if i < a else split[a + (i - a) % p] for i in range(n))
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, text string")


def op13_repair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longest(periodic.find_runs(looped(_table(spark, sf_dir, "documents"))))


def longest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period), digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    found = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
                        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_winnowing": op1_winnowing,
    "op2_feistel_pseudonyms": op2_feistel_pseudonyms,
    "op3_two_stage_suffixes": op3_two_stage_suffixes,
    "op4_factorisation_machine": op4_factorisation_machine,
    "op5_minhash_bayes": op5_minhash_bayes,
    "op6_ecoc_language": op6_ecoc_language,
    "op7_mcd_rules": op7_mcd_rules,
    "op8_temporal_urls": op8_temporal_urls,
    "op9_orc_token_ids": op9_orc_token_ids,
    "op10_cost_packing": op10_cost_packing,
    "op11_seed_extend": op11_seed_extend,
    "op12_branch_and_bound": op12_branch_and_bound,
    "op13_repair_runs": op13_repair_runs,
}

_OP1_SQL = r"""
WITH dw AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bwin AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, list_slice(w, i, i + least(13, len(w)) - 1) AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM bwin),
dwin AS (
  SELECT doc_id, m, i, list_slice(w, i, i + m - 1) AS g
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM dw, lens WHERE len(w) >= m)),
hit AS (SELECT d.doc_id, d.i, d.m, b.item_id FROM dwin d JOIN bwin b ON d.m = b.m AND d.g = b.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(4, len(w)) - 1), ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * both_n >= 80 * (na.n + nb.n - both_n)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
root AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, root.component_id, d.doc_id = root.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN root USING (doc_id)
"""

_OP8_SQL = r"""
WITH p AS (
  SELECT page_id, CAST(DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS DATE) AS fetched,
         nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.$', ''), '') AS host
  FROM pages),
hosts AS (SELECT DISTINCT host AS h FROM p WHERE host IS NOT NULL),
names AS (SELECT h FROM hosts UNION SELECT regexp_replace(h, '^[^.]+\.', '') FROM hosts),
listed AS (
  SELECT h, CAST('0x' || substr(md5(h), 1, 4) AS BIGINT) % 4 AS kind,
         DATE '2024-01-01' + CAST(CAST('0x' || substr(md5(h), 5, 4) AS BIGINT) % 200 AS INTEGER) AS d,
         CAST(CAST('0x' || substr(md5(h), 9, 4) AS BIGINT) % 90 + 10 AS INTEGER) AS held
  FROM names),
valid AS (
  SELECT h AS pattern, CASE kind WHEN 0 THEN 'spam' ELSE 'adult' END AS list, CAST(d AS DATE) AS valid_from, CAST(d + held AS DATE) AS valid_to
  FROM listed WHERE kind < 2
  UNION ALL
  SELECT h, CASE kind WHEN 0 THEN 'spam' ELSE 'adult' END, CAST(d + 2 * held AS DATE), NULL FROM listed WHERE kind < 2),
held AS (
  SELECT page_id, v.*, row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, list, valid_from DESC) AS k
  FROM p JOIN valid v ON (host = pattern OR ends_with(host, '.' || pattern)) AND valid_from <= fetched AND (valid_to IS NULL OR fetched < valid_to))
SELECT p.page_id, p.host, p.fetched, pattern IS NOT NULL AS blocked, pattern, list, valid_from, valid_to
FROM p LEFT JOIN held ON held.page_id = p.page_id AND k = 1
"""

_OP11_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS g
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later),
one AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM one ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: CTE ``crc`` with the table of CRC-32 (reflected polynomial 0xEDB88320); ``%s`` in _CRC is an ASCII string.
_CRC_TABLE = """crc AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) AS r(n))"""
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(%s, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT)"""

_OP12_SQL = r"""
WITH RECURSIVE """ + _CRC_TABLE + r""",
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
          FROM conversations),
k AS (SELECT *, """ + _CRC % "name" + r""" % 20 AS kind FROM named, crc),
dam AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0)),
pos AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, left(role, 1) AS ini FROM dam),
bare AS (SELECT *, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS b, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
                lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS prev FROM pos),
rows_ AS (SELECT *, CASE WHEN b = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(b, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'o' END AS fault FROM bare),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (prev || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM rows_ GROUP BY conv_id),
-- step(i, state): rows taken, then 0 start, 1 system, 2 user, 3 assistant; the least (cost, audit, lines) of each
step AS (
  SELECT conv_id, 0::BIGINT AS i, state, cost, audit, lines
  FROM (SELECT conv_id FROM counts), (VALUES (0, 0, '', ''), (2, 2, 'I', 'user:'), (3, 4, 'II', 'user:' || chr(10) || 'assistant:')) AS v(state, cost, audit, lines)
  UNION ALL
  SELECT conv_id, i, state, best.cost, best.audit, best.lines
  FROM (
    SELECT conv_id, i, state, min({'cost': cost, 'audit': audit, 'lines': lines}) AS best
    FROM (
      SELECT conv_id, i, CASE j WHEN 0 THEN state WHEN 1 THEN one ELSE two END AS state, cost + 2 * j AS cost, audit || repeat('I', j) AS audit,
             lines || CASE WHEN j > 0 THEN CASE WHEN lines = '' THEN '' ELSE chr(10) END || CASE one WHEN 2 THEN 'user:' ELSE 'assistant:' END ELSE '' END
                   || CASE WHEN j > 1 THEN chr(10) || CASE two WHEN 2 THEN 'user:' ELSE 'assistant:' END ELSE '' END AS lines
      FROM (
        SELECT *, CASE WHEN state = 2 THEN 3 ELSE 2 END AS one, CASE WHEN state = 2 THEN 2 ELSE 3 END AS two
        FROM (
          SELECT s.conv_id, r.i, e.edit,
                 CASE e.edit WHEN 'D' THEN s.state WHEN 'K' THEN CASE r.ini WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
                             ELSE CASE WHEN s.state = 2 THEN 3 ELSE 2 END END AS state,
                 s.cost + CASE e.edit WHEN 'D' THEN 3 WHEN 'K' THEN 0 ELSE 2 END + CASE WHEN e.edit <> 'D' AND r.fault = 't' THEN 1 ELSE 0 END AS cost,
                 s.audit || e.edit AS audit,
                 s.lines || CASE WHEN e.edit = 'D' THEN '' ELSE CASE WHEN s.lines = '' THEN '' ELSE chr(10) END
                   || CASE e.edit WHEN 'K' THEN r.role ELSE CASE WHEN s.state = 2 THEN 'assistant' ELSE 'user' END END || ':' || r.text END AS lines
          FROM step s JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1, (VALUES ('D'), ('K'), ('R')) AS e(edit)
          WHERE e.edit = 'D' OR (r.fault IN ('o', 't') AND (e.edit = 'R'
            OR (r.ini = 's' AND s.state = 0) OR (r.ini = 'u' AND s.state <> 2) OR (r.ini = 'a' AND s.state = 2))))),
        (VALUES (0), (1), (2)) AS ins(j))
    GROUP BY conv_id, i, state)),
last AS (
  SELECT s.conv_id, min({'cost': s.cost, 'audit': s.audit, 'lines': s.lines}) AS best
  FROM step s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.i WHERE s.state IN (0, 3) GROUP BY s.conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(best.lines, '')) AS repaired_sha256
FROM ids LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN last l ON l.conv_id IS NOT DISTINCT FROM ids.conv_id
"""

_OP13_SQL = r"""
WITH """ + _CRC_TABLE + r""",
words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT doc_id, w, len(w) AS n, """ + _CRC % "CAST(doc_id AS VARCHAR)" + r""" AS h FROM words, crc),
g AS (SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM g),
tok AS (SELECT doc_id, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
        FROM (SELECT *, unnest(generate_series(0, n - 1)) AS i FROM p WHERE n > 0)),
eq AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM tok x JOIN tok y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isle AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM eq),
stretch AS (SELECT doc_id, q, min(i) AS s, max(i) + 1 + q AS e FROM isle GROUP BY doc_id, q, k),
run AS (SELECT doc_id, s, e - s AS len, min(q) AS q FROM stretch WHERE e - s >= greatest(6, 4 * q) GROUP BY doc_id, s, e),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s + q, s + len - 1)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM tok ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY len DESC, s, q) AS k FROM run),
every_ AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM run GROUP BY doc_id)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(s AS BIGINT) AS start, CAST(len AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
       CAST(1000 * len // q AS BIGINT) AS exponent_milli, sha256(coalesce(every_.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM words w LEFT JOIN every_ USING (doc_id) LEFT JOIN best ON best.doc_id = w.doc_id AND best.k = 1 LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op13_repair_runs": _OP13_SQL,
    "op12_branch_and_bound": _OP12_SQL,
    "op11_seed_extend": _OP11_SQL,
    "op8_temporal_urls": _OP8_SQL,
    "op5_minhash_bayes": _OP5_SQL,
    "op1_winnowing": _OP1_SQL,
}
