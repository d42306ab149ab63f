"""The queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A production job passes its own secret.
PII_KEY = "panelwright"


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_feistel_shards")
def op7(spark, sf_dir):
    """All documents in 24 shards by the Feistel permutation of their rows in doc_id order."""
    from panelwright.llm import sharding

    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharding.assign(rows, "doc_id", "text_crc32", "size", shards=24, seed=7)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_no"
    )


@query("op4_host_quality")
def op4(spark, sf_dir):
    """Measures and verdicts of all documents; a document's source is its host."""
    from panelwright.llm import quality
    from panelwright.llm.common import cut

    measured = cut(quality.measure(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text"))
    rates = cut(quality.host_rates(measured))
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.judged(measured, rates).select(
        "doc_id", *(f"_quality.{m}" for m in shown), "_quality_verdict.base_failed", "_quality_verdict.kept"
    )


ORACLES["op4_host_quality"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
),
pos AS (SELECT rid, words, unnest(range(1, len(words) - 3)) AS p FROM w WHERE len(words) > 5),
win AS (SELECT rid, p, array_to_string(words[p:p + 4], ' ') AS g FROM pos),
twice AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
covered AS (
  SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(p, p + 5)) AS q FROM twice) GROUP BY rid
),
m AS (
  SELECT w.rid, doc_id, host, len(words) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered c ON c.rid = w.rid
),
r AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CAST(n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words) AS INT) AS f1,
         CAST(10 * n_symbols > n_words AS INT) AS f2, CAST(10 * n_dup_lines > 3 * n_lines AS INT) AS f3
  FROM m
),
long AS (
  SELECT host, rule, count(*) AS n, sum(f) AS f FROM (
    SELECT host, unnest([1, 2, 3]) AS rule, unnest([f1, f2, f3]) AS f FROM r) GROUP BY host, rule
),
prior AS (
  SELECT rule, mu, CASE WHEN between_hosts <= 0 THEN 1e6
                        ELSE least(1e6, greatest(1.0, mu * (1 - mu) / between_hosts - 1)) END AS size
  FROM (SELECT rule, mu, q / n - mu * mu - mu * (1 - mu) * hosts / n AS between_hosts
        FROM (SELECT rule, sum(n) AS n, count(*) AS hosts, sum(f) / sum(n) AS mu, sum(f * f / n) AS q FROM long GROUP BY rule))
),
bad AS (
  SELECT host, max(CASE WHEN rule = 1 THEN b END) AS b1, max(CASE WHEN rule = 2 THEN b END) AS b2,
         max(CASE WHEN rule = 3 THEN b END) AS b3
  FROM (SELECT host, rule, CAST(round((f + mu * size) / (n + size), 9) > 0.05 AS INT) AS b FROM long JOIN prior USING (rule))
  GROUP BY host
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND f1 + f2 + f3 < 2 AND f1 * b1 + f2 * b2 + f3 * b3 = 0 AS kept
FROM r JOIN bad USING (host)
"""


@query("op10_low_discrepancy_mix")
def op10(spark, sf_dir):
    """The words that the mix takes from every document."""
    from panelwright.llm import mixing
    from panelwright.llm.common import cut

    rows = mixing.numbered_rows(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    ids = cut(mixing.sizes(rows, keep=("doc_id",)))
    return mixing.plan_mix(ids).join(ids.select("_rid", "doc_id"), "_rid").drop("_rid").select("doc_id", "size", "source_size", "target", "taken")


@query("op5_feistel_pii")
def op5(spark, sf_dir):
    """All documents with their personal data pseudonymised, and the number of values replaced."""
    from panelwright.llm import pii

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return pii.pseudonymised(docs, key=PII_KEY, count="n_replaced")


@query("op6_order_minhash")
def op6(spark, sf_dir):
    """Fingerprints of all texts and their edited forms, and what they say."""
    from panelwright.llm import fingerprints

    return fingerprints.edited_against_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op1_recursive_bpe")
def op1(spark, sf_dir):
    """Ids of all texts and what they decode to, as digests."""
    import public_tokenizers

    from panelwright.llm import bpe

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return done.select(
        "doc_id",
        F.expr("CAST(length(ids) div 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op3_rans_ids")
def op3(spark, sf_dir):
    """All documents' ids written as rANS blocks and read back."""
    import public_tokenizers

    from panelwright.llm import rans
    from panelwright.llm.common import new_folder

    path = new_folder(spark)
    rans.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return rans.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op9_setsketch_neardup")
def op9(spark, sf_dir):
    """Near-duplicate components of all documents at a Jaccard similarity of 0.85 on 3-word shingles."""
    from panelwright.llm import neardup

    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=3, percent=85)


@query("op2_host_paths")
def op2(spark, sf_dir):
    """Main text of all pages by the paths that their hosts agree on."""
    from panelwright.llm import extraction

    done = extraction.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return done.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op8_katz_backoff")
def op8(spark, sf_dir):
    """Scores of all documents by the Katz model of nine tenths of them."""
    from panelwright.llm import katz

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.Katz(docs).scores(docs)


@query("op11_posting_audit")
def op11(spark, sf_dir):
    """What five filters remove from every source, in all their orders."""
    from panelwright.llm import filter_audit

    verdicts = filter_audit.text_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    fails = {name: F.col(name.lower()) for name in "ABCDE"}
    return filter_audit.audit(verdicts, "part", "id", fails, {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")})


ORACLES["op11_posting_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CAST(len(words) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INT)
         + 4 * CAST(100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) AS INT)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(first_id < doc_id, false) AS INT) AS mask
  FROM d LEFT JOIN l USING (doc_id)
),
g AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask),
f AS (SELECT unnest([0, 1, 2, 3, 4]) AS f),
p AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
s AS (
  SELECT array_to_string(list_transform(o, lambda x: substr('ABCDE', x + 1, 1)), '') AS filter_order, step, o[step] AS f,
         CAST(1 << o[step] AS INT) AS own, CAST(coalesce(list_sum(list_transform(o[1:step - 1], lambda x: 1 << x)), 0) AS INT) AS before
  FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
r AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & own > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & own > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM g, s GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""


@query("op12_ball_tree_search")
def op12(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    from panelwright.llm import ball_search

    return ball_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_ball_tree_search"] = r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
q AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)
),
s AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM s),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c
),
v AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))) AS x
  FROM tf JOIN s USING (doc_id) JOIN w USING (term), c
),
r AS (SELECT item_id, doc_id, CAST(sum(x) AS BIGINT) AS score FROM q JOIN v USING (term) GROUP BY item_id, doc_id),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""


@query("op13_warc_transactions")
def op13(spark, sf_dir):
    """All pages as WARC transactions, written, read back and assembled."""
    from panelwright.llm import warc
    from panelwright.llm.common import cut, new_folder

    path = new_folder(spark)
    warc.write(table(spark, sf_dir, "pages"), path)
    read = warc.read(spark, path, payloads=False).select("record_id", "type", "concurrent_to", "refers_to", "block", "payload_bytes", "payload_digest")
    done = warc.resolved(warc.captures(cut(read)))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op13_warc_transactions"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS first_id, count(*) OVER (PARTITION BY html) AS copies FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < first_id THEN first_id END AS refers_to
FROM g
"""
