"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, exact, lines, merkle, pii, quality, secrets, sentence_spans, sentencepieces, simhash, toxicity, warc
from .common import lowered, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: The key of the registered query; a real job passes its own secret.
PII_KEY = "lakeshore public demonstration key"


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = pii.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return masked.select("doc_id", *[pii.count_of(kind).alias(f"n_{kind}") for kind in pii.KINDS], "text")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.digests(sentencepieces.encode_decode(table(spark, sf_dir, "documents"), model))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings that the forest keeps; the secret itself only as a digest."""
    found = secrets.scan(table(spark, sf_dir, "documents")).where("is_secret")
    return found.select("doc_id", "place", F.sha2("candidate", 256).alias("secret_sha256"), F.length("candidate").alias("n_chars"), F.round("score", 6).alias("score"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "n_seeds")


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return lines.remove_boilerplate(docs).select("doc_id", F.col("_n_removed").alias("n_removed"), "text")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_spans.remove_repeats(docs).select("doc_id", F.col("_n_removed").alias("n_removed"), "text")


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    found = alignment.agreement(table(spark, sf_dir, "documents"), *paths)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of every document; of those whose id's CRC-32 five divides, the text is lower-cased before it is verified."""
    fields = [F.col(c) for c in merkle.FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf(*fields[:-1], lowered(fields[-1])))
    found = merkle.manifest(table(spark, sf_dir, "documents"), altered=tampered)
    folded = found.withColumn("folded_root", merkle.folded(F.coalesce("altered", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.siblings_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents"), digests=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_simhash": op1_simhash, "op2_pii": op2_pii, "op3_sentencepiece": op3_sentencepiece, "op4_quality": op4_quality, "op5_secrets": op5_secrets, "op6_decontaminate": op6_decontaminate, "op7_lines": op7_lines, "op8_toxicity": op8_toxicity, "op9_warc": op9_warc, "op10_sentence_spans": op10_sentence_spans, "op11_tokenizer_alignment": op11_tokenizer_alignment, "op12_merkle_manifest": op12_merkle_manifest, "op13_exact_dedup": op13_exact_dedup}

ORACLES: dict[str, str] = {
    "op7_lines": """
        WITH l AS (
            SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents
        ),
        k AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM l),
        b AS (SELECT line, min(doc_id) AS first_id FROM k WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10),
        kept AS (SELECT k.* FROM k LEFT JOIN b ON k.line = b.line WHERE b.line IS NULL OR b.first_id = k.doc_id),
        joined AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY place) AS text, count(*) AS n FROM kept GROUP BY doc_id)
        SELECT d.doc_id, (len(string_split(d.text, chr(10))) - coalesce(j.n, 0))::INT AS n_removed, coalesce(j.text, '') AS text
        FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id
    """,
    "op10_sentence_spans": r"""
        WITH s AS (
            SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i
            FROM (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?]\s+|\s*\n\s*)', '\1' || chr(31), 'g'), chr(31)), lambda x: x <> '') AS parts FROM documents)
        ),
        w AS (SELECT *, regexp_extract_all(part, '\S+') AS words FROM s),
        f AS (
            SELECT doc_id, i, array_to_string(words, ' ') AS t, row_number() OVER d AS k, sum(len(words)) OVER d AS upto, sum(len(words)) OVER d - len(words) AS before
            FROM w WHERE len(words) > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY i)
        ),
        whole AS (SELECT doc_id, list(t ORDER BY k) AS ts, list(i ORDER BY k) AS places, max(upto) AS total FROM f GROUP BY doc_id HAVING count(*) >= 3),
        reach AS (SELECT s.doc_id, s.k, s.i, s.before, e.k AS z FROM f s ASOF LEFT JOIN f e ON s.doc_id = e.doc_id AND s.before + 25 <= e.upto),
        runs AS (SELECT r.doc_id, r.k, r.i, greatest(coalesce(r.z, len(o.ts)), r.k + 2) AS z, o.ts, o.places FROM reach r JOIN whole o ON r.doc_id = o.doc_id WHERE r.z IS NOT NULL OR r.k = 1 OR o.total - r.before >= 12),
        spans AS (SELECT doc_id, i AS a, places[z] AS z, array_to_string(ts[k:z], chr(30)) AS span FROM runs WHERE z <= len(ts)),
        placed AS (SELECT *, row_number() OVER (PARTITION BY span ORDER BY doc_id, a) AS place FROM spans),
        gone AS (SELECT DISTINCT s.doc_id, s.i FROM placed p JOIN s ON p.doc_id = s.doc_id AND s.i BETWEEN p.a AND p.z WHERE place > 1),
        kept AS (SELECT s.doc_id, string_agg(s.part, '' ORDER BY s.i) AS text, count(*) AS n FROM s ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id),
        had AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
        SELECT d.doc_id, (coalesce(h.n, 0) - coalesce(k.n, 0))::INT AS n_removed, coalesce(k.text, '') AS text
        FROM documents d LEFT JOIN had h ON d.doc_id = h.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
    """,
    "op12_merkle_manifest": """
        WITH RECURSIVE fields AS (
            SELECT doc_id, source, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR] AS head, text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text,
                -- CRC-32 of the decimal id, bit by bit
                xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 5 = 0 AS tampered
            FROM documents
        ),
        d AS (
            SELECT doc_id, source, sha256(array_to_string(list_transform(list_append(head, text), lambda x: coalesce(strlen(x)::VARCHAR || ':' || x, '-')), '')) AS leaf,
                sha256(array_to_string(list_transform(list_append(head, CASE WHEN tampered THEN lower_text ELSE text END), lambda x: coalesce(strlen(x)::VARCHAR || ':' || x, '-')), '')) AS told,
                row_number() OVER own - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
            FROM fields WINDOW own AS (PARTITION BY source ORDER BY doc_id NULLS FIRST)
        ),
        up AS (
            SELECT source, 0 AS level, pos, leaf AS digest, n FROM d
            UNION ALL
            SELECT source, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16 FROM up WHERE n > 1 GROUP BY source, level, pos // 16, n
        ),
        subroots AS (SELECT source, digest AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
        top AS (
            SELECT 0 AS level, pos, subroot AS digest, n FROM subroots
            UNION ALL
            SELECT level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY level, pos // 16, n
        ),
        steps AS (
            SELECT source, level, pos, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
                coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
            FROM up WHERE n > 1 WINDOW run AS (PARTITION BY source, level, pos // 16 ORDER BY pos)
        ),
        top_steps AS (
            SELECT level, pos, coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
                coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
            FROM top WHERE n > 1 WINDOW run AS (PARTITION BY level, pos // 16 ORDER BY pos)
        ),
        fold AS (
            SELECT doc_id, source, 0 AS level, pos, told AS digest, '' AS proof FROM d
            UNION ALL
            SELECT f.doc_id, f.source, f.level + 1, f.pos // 16, sha256(s.lft || f.digest || s.rgt), f.proof || s.lft || s.rgt
            FROM fold f JOIN steps s ON f.source IS NOT DISTINCT FROM s.source AND f.level = s.level AND f.pos = s.pos
        ),
        inner_folds AS (SELECT f.doc_id, f.digest, f.proof, r.subroot, r.pos FROM fold f JOIN subroots r ON f.source IS NOT DISTINCT FROM r.source AND f.level = r.height),
        whole AS (
            SELECT doc_id, 0 AS level, pos, digest, proof FROM inner_folds
            UNION ALL
            SELECT w.doc_id, w.level + 1, w.pos // 16, sha256(s.lft || w.digest || s.rgt), w.proof || s.lft || s.rgt FROM whole w JOIN top_steps s ON w.level = s.level AND w.pos = s.pos
        ),
        root AS (SELECT level AS height, digest AS root FROM top WHERE n = 1)
        SELECT d.doc_id, d.leaf, i.subroot, r.root, sha256(w.proof) AS proof_sha256, w.digest AS folded_root, w.digest = r.root AS verified
        FROM d JOIN inner_folds i ON d.doc_id = i.doc_id JOIN root r ON true JOIN whole w ON w.doc_id = d.doc_id AND w.level = r.height
    """,
    "op13_exact_dedup": """
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM d WINDOW same AS (PARTITION BY t)
    """,
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        h AS (SELECT page_id, strlen(html) AS n, sha1(html) AS hex FROM p),
        d AS (
            SELECT page_id, n, min(page_id) OVER (PARTITION BY hex) AS first_id,
                list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
                    ((16 * (instr('0123456789abcdef', substr(hex, (5 * i // 4 + 1)::INT, 1)) - 1) + instr('0123456789abcdef', substr(hex, (5 * i // 4 + 2)::INT, 1)) - 1)
                    >> (3 - 5 * i % 4)::INT) & 31))::INT, 1)), 'string_agg', '') AS digest
            FROM h
        )
        SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
            CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first_id < page_id THEN first_id END AS refers_to
        FROM d
    """,
}
