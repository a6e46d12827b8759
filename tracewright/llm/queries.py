"""The registered queries of the corpus operators, and their SQL where it can express them."""

from __future__ import annotations

from . import op1_pii, op2_shards, op3_token_counts, op4_maxscore, op5_mix, op6_licenses, op7_simhash, op8_minhash, op9_langid, op10_bpe, op11_centroids, op12_importance, op13_collisions


def queries() -> dict:
    return {
        "op1_pii": op1_pii.op1_pii,
        "op2_shards": op2_shards.op2_shards,
        "op3_token_counts": op3_token_counts.op3_token_counts,
        "op4_maxscore": op4_maxscore.op4_maxscore,
        "op5_mix": op5_mix.op5_mix,
        "op6_license_scan": op6_licenses.op6_license_scan,
        "op7_simhash": op7_simhash.op7_simhash,
        "op8_minhash": op8_minhash.op8_minhash,
        "op9_langid": op9_langid.op9_langid,
        "op10_bpe": op10_bpe.op10_bpe,
        "op11_centroids": op11_centroids.op11_centroids,
        "op12_importance": op12_importance.op12_importance,
        "op13_collisions": op13_collisions.op13_collisions,
    }


def oracle_sql() -> dict:
    return {
        "op1_pii": op1_pii.ORACLE_SQL,
        "op3_token_counts": op3_token_counts.ORACLE_SQL,
        "op4_maxscore": op4_maxscore.ORACLE_SQL,
        "op5_mix": op5_mix.ORACLE_SQL,
        "op6_license_scan": op6_licenses.ORACLE_SQL,
        "op11_centroids": op11_centroids.ORACLE_SQL,
        "op12_importance": op12_importance.ORACLE_SQL,
        "op13_collisions": op13_collisions.ORACLE_SQL,
    }
