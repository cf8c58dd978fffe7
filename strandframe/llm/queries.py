"""The subpackage's queries, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from .additive_ann import op1_additive_ann
from .decontaminate import op7_simhash_decontamination
from .karmarkar_karp import op5_karmarkar_karp
from .minhash_dedup import op8_minhash_dedup
from .mixing import op10_ipf_mixing
from .pii import op6_bootstrapped_pii
from .quality import op9_pu_quality
from .relative_lz import op4_relative_lz
from .suffix_dedup import op2_suffix_dedup
from .warc import op3_warc_transactions

QUERIES = {
    f.__name__: f
    for f in (op1_additive_ann, op2_suffix_dedup, op3_warc_transactions, op4_relative_lz, op5_karmarkar_karp, op6_bootstrapped_pii, op7_simhash_decontamination, op8_minhash_dedup, op9_pu_quality, op10_ipf_mixing)
}

ORACLE_SQL = {
    "op3_warc_transactions": """
        WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS d, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS b FROM pages),
        k AS (SELECT d, max(page_id) AS keeper FROM p WHERE b >= 1000 GROUP BY d)
        SELECT page_id, b AS payload_bytes, p.d AS payload_digest,
               CASE WHEN b >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN b >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
        FROM p LEFT JOIN k ON p.d = k.d""",
}
