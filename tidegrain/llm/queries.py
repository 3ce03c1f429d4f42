"""Registered queries of the training-data operators, each over its whole tables, and the SQL of those that SQL can state."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegrain.llm import contamination, credentials, exact_stream, interpolation, language, mixing, periodic, phrases, pseudonyms, simhash, substring, token_files, warc
from tidegrain.llm.common import crc_mod, table

#: Key of the registered query; a real job passes its own secret.
PSEUDONYM_KEY = b"tidegrain example key"
#: The public byte-level BPE; its path is a parameter of the operator.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_deleted_interpolation(spark: SparkSession, root: str) -> DataFrame:
    held_out, tuning = crc_mod("doc_id", 7) == 2, crc_mod("doc_id", 7) == 6
    found = interpolation.score(spark, f"{root.rstrip('/')}/documents.parquet", ~held_out, tuning)
    return found.withColumn("held_out", crc_mod("doc_id", 7) == 2)


def op2_mix_sources(spark: SparkSession, root: str) -> DataFrame:
    return mixing.shares(table(spark, root, "documents"))


def op3_exact_dedup(spark: SparkSession, root: str) -> DataFrame:
    return exact_stream.deduplicate(spark, f"{root.rstrip('/')}/documents.parquet")


def op4_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    found = language.identify(docs, ~held_out)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op5_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    return contamination.digests(contamination.decontaminate(table(spark, root, "documents"), table(spark, root, "benchmark")))


def op6_pseudonymize(spark: SparkSession, root: str) -> DataFrame:
    return pseudonyms.counted(pseudonyms.pseudonymize(table(spark, root, "documents"), PSEUDONYM_KEY))


def op7_token_files(spark: SparkSession, root: str) -> DataFrame:
    return token_files.round_trip(table(spark, root, "documents"), TOKENIZER)


def op8_simhash_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, root, "documents"))


def op9_warc_split_reader(spark: SparkSession, root: str) -> DataFrame:
    return warc.archived(table(spark, root, "pages"), min_bytes=0)


def op10_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    return substring.digests(substring.remove_repeated(table(spark, root, "documents")))


def op11_collocations(spark: SparkSession, root: str) -> DataFrame:
    return phrases.collocations(table(spark, root, "documents"))


def op12_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    return credentials.digests(credentials.find_secrets(table(spark, root, "documents")))


def op13_periodic_runs(spark: SparkSession, root: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(periodic.with_planted_tails(table(spark, root, "documents"))))


QUERIES = {f.__name__: f for f in (
    op1_deleted_interpolation, op2_mix_sources, op3_exact_dedup, op4_language_id, op5_decontaminate, op6_pseudonymize, op7_token_files, op8_simhash_near_dedup, op9_warc_split_reader,
    op10_substring_dedup, op11_collocations, op12_secret_scan, op13_periodic_runs)}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

LETTERS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL = {
    "op2_mix_sources": f"""
        WITH d AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source),
        w AS (SELECT *, CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
        l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
                     / sum(weight) OVER (ORDER BY source_size / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM w),
        t AS (SELECT *, least(CAST(3 * source_size AS DOUBLE), max(lv) OVER () * weight) AS target FROM l),
        q AS (SELECT *, least(CAST(floor(target + 0.5) AS BIGINT), 3 * source_size) AS quota FROM t),
        p AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.quota, CAST(sum(d.size) OVER (
                  PARTITION BY sid ORDER BY md5(concat_ws(':', 'mix', CAST(d.doc_id AS VARCHAR), CAST(d.size AS VARCHAR))), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS pos
              FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
        SELECT doc_id, size, source_size, target,
               CAST(CASE WHEN size = 0 THEN 0 ELSE quota // source_size * size + greatest(0, least(pos + size, quota % source_size) - pos) END AS BIGINT) AS taken FROM p""",
    "op3_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g USING (t)""",
    "op5_decontaminate": rf"""
        WITH d AS (SELECT doc_id, {LETTERS} AS w FROM documents),
        b AS (SELECT item_id, {LETTERS} AS w FROM benchmark),
        win AS (SELECT item_id, array_to_string(w[p:p + 12], ' ') AS k, least(13, len(w)) AS n
                FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM b WHERE len(w) > 0) s),
        sizes AS (SELECT DISTINCT n FROM win),
        grams AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS k
                  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n) s),
        occ AS (SELECT doc_id, p, n, k FROM grams SEMI JOIN win USING (k, n)),
        hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS i FROM occ) s GROUP BY doc_id),
        named AS (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ JOIN win USING (k, n)),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM named GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id""",
    "op9_warc_split_reader": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        g AS (SELECT h, max(page_id) AS last_id FROM p GROUP BY h),
        x AS (SELECT h, last_id, list_transform(range(0, 8), lambda a: list_sum(list_transform(range(1, 6), lambda b:
                 (strpos('0123456789abcdef', substr(sha1(h), 5 * a + b, 1)) - 1) * CAST(pow(16, 5 - b) AS BIGINT)))) AS v FROM g)
        SELECT page_id, CAST(octet_length(encode(p.h)) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v[k // 4 + 1] // CAST(pow(2, 15 - 5 * (k % 4)) AS BIGINT) % 32 + 1 AS BIGINT), 1)), '') AS payload_digest,
               CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last_id THEN last_id END AS refers_to
        FROM p JOIN x ON p.h = x.h""",
    "op10_substring_dedup": rf"""
        WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
        win AS (SELECT doc_id, p, array_to_string(w[p:p + 49], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50) s),
        firsts AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
        gone AS (SELECT DISTINCT doc_id, i FROM (SELECT win.doc_id, unnest(range(p, p + 50)) AS i FROM win JOIN firsts USING (k) WHERE m < win.doc_id) s),
        words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
        kept AS (SELECT words.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY words.doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op11_collocations": r"""
        WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        pieces AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
        places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM pieces),
        grams AS (SELECT lang, m, array_to_string(w[p:p + m - 1], ' ') AS k FROM (SELECT lang, w, p, unnest(range(1, least(5, len(w) - p + 1) + 1)) AS m FROM places) s),
        f AS (SELECT lang, m, k, count(*) AS c FROM grams GROUP BY lang, m, k HAVING count(*) >= 100),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
        cand AS (SELECT lang, m, k, c AS a, string_split(k, ' ') AS w FROM f WHERE m > 1),
        sub AS (SELECT lang, a, array_to_string(w[p:p + q - 1], ' ') AS k FROM (SELECT lang, a, m, w, q, unnest(range(1, m - q + 2)) AS p FROM (SELECT *, unnest(range(2, m)) AS q FROM cand) s) s),
        longer AS (SELECT lang, k, max(a) AS most FROM sub GROUP BY lang, k),
        kept AS (SELECT cand.* FROM cand LEFT JOIN longer USING (lang, k) WHERE most IS NULL OR 100 * most < 100 * a),
        cuts AS (SELECT lang, k, a, i, array_to_string(w[1:i], ' ') AS lk, array_to_string(w[i + 1:m], ' ') AS rk FROM (SELECT *, unnest(range(1, m)) AS i FROM kept) s),
        scored AS (SELECT cuts.lang, cuts.k, a, i, fl.c AS l, fr.c AS r, n, (1000::HUGEINT * a * n // (fl.c::HUGEINT * fr.c))::BIGINT AS score
                   FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.k = lk JOIN f fr ON fr.lang = cuts.lang AND fr.k = rk JOIN totals ON totals.lang = cuts.lang),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, k ORDER BY score, i) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, k) AS rank, k AS phrase, a, l, r, n, score FROM best
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, k) <= 2000""",
}
