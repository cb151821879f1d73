"""The operators of this package as registered queries over the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.llm.chat import chat_events, format_chats
from lapwise.llm.decontaminate import find_leaks
from lapwise.llm.langid import fit_language_model, identify_language
from lapwise.llm.licenses import license_scan
from lapwise.llm.line_dedup import drop_lines, line_index
from lapwise.llm.merkle import fold, leaf, manifest, proofs, siblings
from lapwise.llm.ngram_jaccard import ngram_jaccard
from lapwise.llm.packing import Capacity, pack
from lapwise.llm.quality import fit_quality, score_quality
from lapwise.llm.repair import repair_conversations, summaries
from lapwise.llm.samples import remainder
from lapwise.llm.topk import exact_top_k
from lapwise.llm.toxicity import fit_toxicity, score_toxicity
from lapwise.llm.warc import archive_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
        FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
        FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
        WHERE 100 * c >= 90 * (x.n + y.n - c)),
    reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM documents
        UNION
        SELECT r.doc_id, CASE WHEN l.a = r.other THEN l.b ELSE l.a END
        FROM reach r JOIN links l ON r.other = l.a OR r.other = l.b)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, d.component_id
    FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) d LEFT JOIN n USING (doc_id)
    """
)
def op1_ngram_jaccard(spark, sf_dir):
    found = ngram_jaccard(table(spark, sf_dir, "documents"), width=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


@query()
def op3_license_scan(spark, sf_dir):
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query(
    r"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    sized AS (
        SELECT *, length(role) + length(text) + len(regexp_extract_all(role || chr(0) || text, '\\'))
            + len(regexp_extract_all(role || chr(0) || text,
                '<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<\|endoftext\|>|<\|system\|>|<\|user\|>|<\|assistant\|>'
                || '|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS escaped
        FROM rows)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        (sum(escaped + length('<|im_start|><|im_sep|><|im_end|>')) + count(*) - 1)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
    """
)
def op4_chat_format(spark, sf_dir):
    """Every row is a message of its own, streamed, regenerated or edited; rows that tie on turn go by role and text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    found = format_chats(chat_events(rows.unionByName(own)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return found.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query(
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
    SELECT query_id, rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    WHERE rank <= 10
    """
)
def op10_exact_top_k(spark, sf_dir):
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query()
def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    third = remainder("doc_id", 3)
    model = fit_language_model(docs.where(~third.eqNullSafe(F.lit(1))))
    found = identify_language(docs, model)
    return found.select("doc_id", third.eqNullSafe(F.lit(1)).alias("held_out"), "lang_pred", "score")


def training_labels(spark, sf_dir):
    """Labels but for documents whose crc32 modulo 4 is 2."""
    return table(spark, sf_dir, "labels").where(~remainder("doc_id", 4).eqNullSafe(F.lit(2)))


def judged(found, threshold):
    held_out = remainder("doc_id", 4).eqNullSafe(F.lit(2))
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


@query()
def op9_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, training_labels(spark, sf_dir))
    return judged(score_toxicity(docs, model, spans=False), 0.3)


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op6_best_fit_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), Capacity(tokens=2048))


@query(
    r"""
    WITH p AS (
        SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS hex FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_page FROM p)
    SELECT page_id, octet_length(payload) AS payload_bytes,
        list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31)::INT, 1)),
            'string_agg', '') AS payload_digest,
        CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first_page THEN first_page END AS refers_to
    FROM f
    """
)
def op7_warc(spark, sf_dir):
    found = archive_pages(table(spark, sf_dir, "pages"), least_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, training_labels(spark, sf_dir))
    return judged(score_quality(docs, model), 0.7)


@query()
def op2_decontamination(spark, sf_dir):
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: crc32 of an ASCII text ``s`` in a table, bit by bit: each byte is followed by eight steps.
_CRC32_SQL = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, length(s) + 1),
            lambda i: [ascii(s[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
            lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""


@query(
    rf"""
    WITH RECURSIVE fields AS (
        SELECT doc_id, source, doc_id::VARCHAR AS s,
            list_transform([doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text],
                lambda x: CASE WHEN x IS NULL THEN '-' ELSE octet_length(encode(x)) || ':' || x END) AS f,
            replace(text, chr(10), '') AS flat
        FROM documents),
    tampering AS (SELECT *, {_CRC32_SQL} % 2 = 0 AS tampers FROM fields),
    leaves AS (
        SELECT doc_id, source, sha256(array_to_string(f, '')) AS leaf,
            CASE WHEN tampers AND flat IS NOT NULL
                THEN sha256(array_to_string(f[1:4], '') || octet_length(encode(flat)) || ':' || flat)
                ELSE sha256(array_to_string(f, '')) END AS tampered
        FROM tampering),
    placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS i FROM leaves),
    trees AS (
        SELECT source, 0 AS level, list(leaf ORDER BY i) AS nodes FROM placed GROUP BY source
        UNION ALL
        SELECT source, level + 1, list_transform(range(0, (len(nodes) + 2) // 3),
            lambda k: sha256(array_to_string(nodes[3 * k + 1:3 * k + 3], '')))
        FROM trees WHERE len(nodes) > 1),
    subroots AS (
        SELECT source, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j
        FROM trees WHERE len(nodes) = 1),
    top AS (
        SELECT 0 AS level, list(subroot ORDER BY j) AS nodes FROM subroots
        UNION ALL
        SELECT level + 1, list_transform(range(0, (len(nodes) + 2) // 3),
            lambda k: sha256(array_to_string(nodes[3 * k + 1:3 * k + 3], '')))
        FROM top WHERE len(nodes) > 1),
    levels AS (
        SELECT source, level, nodes, false AS on_top FROM trees WHERE len(nodes) > 1
        UNION ALL SELECT s.source, s.height + t.level, t.nodes, true FROM subroots s, top t WHERE len(t.nodes) > 1),
    walk AS (
        SELECT doc_id, p.source, i AS i, j, tampered AS folded, '' AS proof, 0 AS level
        FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
        UNION ALL
        SELECT doc_id, source, i, j, sha256(before || folded || after), proof || before || after, level
        FROM (
            SELECT w.doc_id, w.source, pos // 3 AS i, w.j, w.folded, w.proof, w.level + 1 AS level,
                array_to_string(nodes[pos // 3 * 3 + 1:pos], '') AS before, array_to_string(nodes[pos + 2:pos // 3 * 3 + 3], '') AS after
            FROM (
                SELECT w.*, l.nodes, CASE WHEN l.on_top AND l.level = s.height THEN w.j ELSE w.i END AS pos
                FROM walk w JOIN levels l ON w.source IS NOT DISTINCT FROM l.source AND w.level = l.level
                JOIN subroots s ON w.source IS NOT DISTINCT FROM s.source) w)),
    ends AS (SELECT doc_id, max_by(folded, level) AS folded_root, max_by(proof, level) AS proof FROM walk GROUP BY doc_id)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source JOIN ends USING (doc_id),
        (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1)
    """
)
def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tampers = remainder("doc_id", 2) == 0
    text = F.when(tampers, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select("doc_id", "source", leaf(*head, F.col("text")).alias("leaf"), leaf(*head, text).alias("tampered"))
    found = proofs(manifest(leaves, "source", "doc_id", "leaf", keep=("tampered",)))
    folded = found.withColumn("folded_root", fold(F.col("tampered"), F.col("proof")))
    return folded.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query(
    r"""
    WITH lines AS (
        SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
    frequent AS (
        SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
    decided AS (SELECT l.*, f.key IS NULL AS stays FROM lines l LEFT JOIN frequent f USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
    FROM decided GROUP BY doc_id
    """
)
def op12_line_dedup(spark, sf_dir):
    """The benchmark's items go in beside the documents and out again, so that the result also rests on deletion."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    index = line_index(spark, least_documents=10, least_chars=1).insert(docs).insert(items).remove(items)
    found = drop_lines(docs, index)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_OP11_SQL = rf"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s
        FROM conversations),
    hashed AS (SELECT *, {_CRC32_SQL} % 20 AS harm FROM keyed),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
            CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE WHEN harm = 3 THEN [1, 2] ELSE [1] END) AS copy
        FROM hashed WHERE harm <> 0),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
    seen AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
            rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
            lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair
        FROM numbered),
    faulty AS (
        SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate'
            WHEN bare[-1:] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
        FROM seen),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated,
            count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM faulty GROUP BY conv_id),
    -- Edit lists, step by step: the state reached is n (nothing), s, u or a; per state the cheapest, then least one stays.
    choices(state, initial, after, cost, letters, add, takes) AS (
        SELECT * FROM (VALUES
            ('n', 's', 's', 0, 'K', '', ''), ('n', 'u', 'u', 0, 'K', '', ''), ('n', 'a', 'a', 2, 'IK', 'user:', ''),
            ('s', 'u', 'u', 0, 'K', '', ''), ('s', 'a', 'a', 2, 'IK', 'user:', ''),
            ('u', 'u', 'u', 2, 'IK', 'assistant:', ''), ('u', 'a', 'a', 0, 'K', '', ''),
            ('a', 'u', 'u', 0, 'K', '', ''), ('a', 'a', 'a', 2, 'IK', 'user:', ''),
            ('n', '', 'u', 2, 'R', '', 'user'), ('n', '', 'a', 4, 'IR', 'user:', 'assistant'),
            ('s', '', 'u', 2, 'R', '', 'user'), ('s', '', 'a', 4, 'IR', 'user:', 'assistant'),
            ('u', '', 'u', 4, 'IR', 'assistant:', 'user'), ('u', '', 'a', 2, 'R', '', 'assistant'),
            ('a', '', 'u', 2, 'R', '', 'user'), ('a', '', 'a', 4, 'IR', 'user:', 'assistant'),
            ('n', '', 'n', 3, 'D', '', NULL), ('s', '', 's', 3, 'D', '', NULL),
            ('u', '', 'u', 3, 'D', '', NULL), ('a', '', 'a', 3, 'D', '', NULL)) t),
    walk AS (
        SELECT conv_id, 0::BIGINT AS i, 'n' AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS repaired
        FROM (SELECT DISTINCT conv_id FROM faulty)
        UNION ALL
        SELECT conv_id, i, state, cost, audit, repaired
        FROM (
            SELECT w.conv_id, f.i, c.after AS state, w.cost + c.cost + CASE WHEN f.fault = 'truncated' AND c.takes IS NOT NULL THEN 1 ELSE 0 END AS cost,
                w.audit || c.letters AS audit,
                w.repaired || CASE WHEN c.add = '' THEN []::VARCHAR[] ELSE [c.add] END || CASE WHEN c.takes IS NULL THEN []::VARCHAR[]
                    WHEN c.takes = '' THEN [f.role || ':' || f.text] ELSE [c.takes || ':' || f.text] END AS repaired,
                row_number() OVER (PARTITION BY w.conv_id, c.after ORDER BY w.cost + c.cost + CASE WHEN f.fault = 'truncated' AND c.takes IS NOT NULL THEN 1 ELSE 0 END,
                    w.audit || c.letters) AS place
            FROM walk w JOIN faulty f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1
            JOIN choices c ON c.state = w.state AND (c.initial = '' OR c.initial = f.role[1:1])
                AND (c.takes IS NULL OR f.fault NOT IN ('blank', 'duplicate'))) t
        WHERE place = 1),
    endings(state, cost, letters, add) AS (
        SELECT * FROM (VALUES ('n', 0, '', []::VARCHAR[]), ('a', 0, '', []::VARCHAR[]), ('u', 2, 'I', ['assistant:']),
            ('s', 4, 'II', ['user:', 'assistant:'])) t),
    best AS (
        SELECT w.conv_id, w.cost + e.cost AS cost, w.audit || e.letters AS audit, w.repaired || e.add AS repaired,
            row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + e.cost, w.audit || e.letters) AS place
        FROM walk w JOIN endings e USING (state)
        WHERE w.i = (SELECT max(f.i) FROM faulty f WHERE f.conv_id IS NOT DISTINCT FROM w.conv_id))
    SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
        coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
        coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.repaired, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) o
    LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id AND b.place = 1
    """


def damaged(rows):
    """Conversations with rows dropped, emptied, without sentence ends, repeated, or under another role, by their crc32."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.pmod(F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")), F.lit(20))
    text = F.when(harm == 1, F.lit("")).when(harm == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(harm == 4, F.lit("user")).otherwise(known("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(harm == 3, 2).otherwise(1)))
    return rows.where(harm != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))


@query(_OP11_SQL)
def op11_structure_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = summaries(repair_conversations(damaged(rows)))
    every = rows.select(F.col("conv_id").alias("of")).distinct()
    joined = every.join(found, F.col("of").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return joined.select(F.col("of").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)
