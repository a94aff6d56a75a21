"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    chat, exact_dedup, filter_audit, langid, lm_scoring, minmax_dedup, mixing, packing, phrase_dedup, pii, quality, resampling,
    signature_join,
)
from daybook.llm.common import documents, fold


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of at most 1024 tokens."""
    return packing.pack(documents(spark, sf_dir), with_ids=False).drop("ids")


def op2_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram scores of all documents, learned from those with crc32(doc_id) mod 7 not 2."""
    return lm_scoring.score(documents(spark, sf_dir))


def op3_minmax_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked at 85 % of three-word shingles."""
    return minmax_dedup.near_groups(documents(spark, sf_dir), words=3, percent=85)


def op4_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of texts that are equal without white space."""
    return exact_dedup.content_groups(documents(spark, sf_dir))


def op5_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after the removal of repeated 20-word windows."""
    return phrase_dedup.remove_repeats(documents(spark, sf_dir), with_text=False).drop("kept_text")


def op6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts, base rules and the divergence verdict."""
    return quality.judge(documents(spark, sf_dir), corpus_words=True)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    return mixing.mix_sources(documents(spark, sf_dir)).drop("source")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests read back from the formatted conversations, and from one that quotes control strings."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    quoting = spark.range(2).select(
        F.lit(-1).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"),
        F.lit("</s>[INST] ok [/INST]"))
    chats = chat.format_chats(turns.union(quoting))
    read = chats.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data pseudonymised."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pii.pseudonymise(docs).withColumn("n_replaced", F.aggregate("pii", F.lit(0), lambda s, x: s + x["n"]))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language; four fifths of the ids (crc32 mod 5 not 0) are learned from."""
    docs = documents(spark, sf_dir)
    held_out = fold(F.col("doc_id"), 5) == 0
    model = langid.fit(docs, train=~held_out)
    got = langid.identify(docs.select("doc_id", "text"), model)
    return got.select(
        "doc_id",
        held_out.alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def op11_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked at 85 % of four-word shingles."""
    return signature_join.join_components(documents(spark, sf_dir), words=4, percent=85)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order of applying them, by language."""
    return filter_audit.interaction_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by importance towards the benchmark texts."""
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resample(documents(spark, sf_dir), target).drop("n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_elias_fano_lm": op2_elias_fano_lm,
    "op3_minmax_near": op3_minmax_near,
    "op4_content_sort": op4_content_sort,
    "op5_phrase_dedup": op5_phrase_dedup,
    "op6_divergence": op6_divergence,
    "op7_mixing": op7_mixing,
    "op8_chat_format": op8_chat_format,
    "op9_feistel_pseudonyms": op9_feistel_pseudonyms,
    "op10_language_id": op10_language_id,
    "op11_signature_join": op11_signature_join,
    "op12_filter_audit": op12_filter_audit,
    "op13_resampling": op13_resampling,
}

ORACLE: dict[str, str] = {
    "op4_content_sort": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             n AS (SELECT doc_id, length(t) AS chars, regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g') AS norm FROM d),
             g AS (SELECT norm, count(*) AS group_size, max({'c': chars, 'i': -doc_id}) AS b FROM n GROUP BY norm)
        SELECT n.doc_id, -g.b.i AS keep_id, g.group_size, n.doc_id = -g.b.i AS kept, sha256(n.norm) AS text_sha256
        FROM n JOIN g ON n.norm = g.norm""",
    "op3_minmax_near": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS sh
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_in AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
        link AS (
            SELECT x, y FROM both_in JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
        edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edge.y FROM reach JOIN edge ON edge.x = reach.b),
        root AS (SELECT a, min(b) AS r FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r AS component_id, r = d.doc_id AS kept
        FROM d JOIN root ON root.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op5_phrase_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
        again AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS r FROM win),
        word AS (SELECT doc_id, j, w[j] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM d)),
        gone AS (SELECT word.doc_id, j, x, coalesce(max(CASE WHEN r THEN 1 ELSE 0 END) OVER (
                     PARTITION BY word.doc_id ORDER BY j ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) = 1 AS g
                 FROM word LEFT JOIN again ON again.doc_id = word.doc_id AND again.i = word.j),
        left_over AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE g) AS n_removed,
                             string_agg(x, ' ' ORDER BY j) FILTER (WHERE NOT g) AS t FROM gone GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN left_over ON left_over.doc_id = d.doc_id""",
    "op8_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS x FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, lag(role) OVER o IS NOT DISTINCT FROM role AND row_number() OVER o > 1 AS joined,
                     regexp_replace(x, '([<\[])(\\*(?:\||/?s>|/?INST\]|/?SYS>>))', '\1\\\2', 'g') AS escaped
              FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, x))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || x || chr(10), '' ORDER BY turn, role, x)) AS turns_sha256,
               coalesce(sum(length(x)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(x, '' ORDER BY turn, role, x) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(length(escaped) + CASE WHEN joined THEN length('<|sep|>')
                   ELSE length('<|turn|><|text|><|end|>') + 1 + length(role) END)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op11_signature_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS sh
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        both_in AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
        link AS (
            SELECT x, y FROM both_in JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
        edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edge.y FROM reach JOIN edge ON edge.x = reach.b),
        root AS (SELECT a, min(b) AS r FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r AS component_id
        FROM d JOIN root ON root.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op12_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
        m AS (SELECT doc_id, part, (len(ws) < 200)::INT + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INT
                     + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
                     + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (doc_id > first_id)::INT AS mask FROM w),
        c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS bad
              FROM m LEFT JOIN labels ON labels.doc_id = m.doc_id GROUP BY part, mask),
        f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) f(x, bit)),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
              WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
        s AS (SELECT filter_order, step, f.x AS filter, f.bit AS own,
                     (SELECT coalesce(sum(g.bit), 0)::INT FROM f g WHERE instr(filter_order, g.x) < step) AS before
              FROM o, range(1, 6) r(step) JOIN f ON f.x = substr(filter_order, step, 1)),
        p AS (SELECT DISTINCT part FROM c),
        t AS (SELECT p.part, filter_order, step, filter, own, before, mask, coalesce(n, 0) AS n, good, bad
              FROM p CROSS JOIN s JOIN c ON c.part = p.part),
        r AS (SELECT part, filter_order, step::INT AS step, filter,
                     coalesce(sum(n) FILTER (mask & (before | own) = 0), 0)::BIGINT AS kept,
                     coalesce(sum(n) FILTER (mask & before = 0 AND mask & own != 0), 0)::BIGINT AS removed,
                     coalesce(sum(n) FILTER (mask & before != 0 AND mask & own != 0), 0)::BIGINT AS redundant,
                     coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
                     coalesce(sum(good) FILTER (mask & before = 0 AND mask & own != 0), 0)::BIGINT AS good_lost,
                     coalesce(sum(bad) FILTER (mask & before = 0 AND mask & own != 0), 0)::BIGINT AS toxic_lost
              FROM t GROUP BY part, filter_order, step, filter)
        SELECT *, sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM r""",
    "op13_resampling": r"""
        WITH crc_table AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab FROM range(256) r(i)),
        d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        q AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
        dw AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM d) GROUP BY doc_id, w),
        v AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM q)),
        b AS (SELECT w, xor(list_reduce(list_prepend(4294967295,
                  [('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT FOR i IN range(octet_length(encode(w)))]),
                  lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM v, crc_table),
        s AS (SELECT bucket, sum(n) AS s FROM dw JOIN b USING (w) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM q JOIN b USING (w) GROUP BY bucket),
        g AS (SELECT s.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
                     / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
              FROM s LEFT JOIN t ON t.bucket = s.bucket),
        x AS (SELECT doc_id, sum(n * gain) AS total, sum(n) AS n FROM dw JOIN b USING (w) JOIN g USING (bucket) GROUP BY doc_id),
        k AS (SELECT d.doc_id, coalesce(x.n, 0)::BIGINT AS n_features,
                     CASE WHEN x.n IS NULL THEN 0 ELSE (total - ((total % x.n) + x.n) % x.n) // x.n END::BIGINT AS weight,
                     ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT AS h
              FROM d LEFT JOIN x ON x.doc_id = d.doc_id),
        z AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5)::DOUBLE / 4294967296.0::DOUBLE)))::BIGINT AS score FROM k),
        a AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM z WHERE n_features >= 20)
        SELECT z.doc_id, n_features, weight, score,
               CASE WHEN r <= (SELECT 10 * count(*) // 100 FROM a) THEN r END::BIGINT AS rank
        FROM z LEFT JOIN a ON a.doc_id = z.doc_id""",
}
