"""The operators over the whole test tables, with the parameters meant for production."""

from __future__ import annotations

import public_tokenizers

from goldseam.llm import boosting, bpe, chat, crosstoken, decontamination, jaccard, langid, licenses, negatives, outliers, pii, toxicity, warc
from goldseam.llm.common import table
from goldseam.llm.registry import ORACLES, QUERIES, query
from goldseam.session import scratch_path

__all__ = ["ORACLES", "QUERIES"]

VOCABULARY = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model")


def documents(spark, folder, *more):
    return table(spark, folder, "documents", "doc_id", "text", *more)


@query(
    "op1_warc",
    """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, upper(sha1(coalesce(html, ''))) AS h FROM pages
    ), d AS (
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
               translate(to_base(CAST('0x' || substr(h, 1, 15) AS BIGINT), 32, 12)
                      || to_base(CAST('0x' || substr(h, 16, 15) AS BIGINT), 32, 12)
                      || to_base(CAST('0x' || substr(h, 31, 10) AS BIGINT), 32, 8),
                         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
        FROM p
    ), m AS (
        SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS chosen FROM d
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM chosen THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM chosen THEN chosen END AS refers_to
    FROM m
    """,
)
def op1(spark, folder):
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.plan_records(pages), path)
    return warc.read_records(spark, path, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


@query("op2_language")
def op2(spark, folder):
    return langid.identify(documents(spark, folder, "lang"))


@query("op3_outliers")
def op3(spark, folder):
    return outliers.judge(documents(spark, folder, "lang", "source"))


@query("op4_quality")
def op4(spark, folder):
    return boosting.grade(documents(spark, folder), table(spark, folder, "labels", "doc_id", "quality"))


@query("op5_bpe")
def op5(spark, folder):
    return bpe.round_trip(documents(spark, folder), public_tokenizers.path(VOCABULARY))


@query("op6_pii")
def op6(spark, folder):
    return pii.report(documents(spark, folder))


@query("op7_licenses")
def op7(spark, folder):
    return licenses.scan(documents(spark, folder))


@query("op8_decontamination", decontamination.contamination_sql())
def op8(spark, folder):
    return decontamination.contamination(documents(spark, folder), table(spark, folder, "benchmark", "item_id", "text"))


@query("op9_jaccard")
def op9(spark, folder):
    return jaccard.components(documents(spark, folder))


@query("op10_toxicity")
def op10(spark, folder):
    return toxicity.judge(documents(spark, folder), table(spark, folder, "labels", "doc_id", "toxic"))


@query("op11_chat", chat.digests_sql())
def op11(spark, folder):
    return chat.digests(chat.with_probe(table(spark, folder, "conversations", "conv_id", "turn", "role", "text")), contexts=True)


@query("op12_negatives", negatives.SQL)
def op12(spark, folder):
    return negatives.mine(table(spark, folder, "embeddings", "vec_id", "label", "embedding"), relabel=negatives.shifted_label())


@query("op13_crosstoken")
def op13(spark, folder):
    return crosstoken.statistics(documents(spark, folder), tuple(map(public_tokenizers.path, ALIGNED)))
