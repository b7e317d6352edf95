"""The corpus operators' queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidelake.llm import bestfit, chat_format, media_flac, nbest_pieces, pii, secrets_markov, simhash_bk, toxicity, url_vocab, winnow


def queries() -> dict:
    import corpus_pipeline

    every = (
        media_flac.op1_flac_media, simhash_bk.op2_simhash_bk_dedup, pii.op3_pii_spans, secrets_markov.op4_secret_markov, url_vocab.op5_url_vocabulary,
        toxicity.op6_toxicity_weak, winnow.op7_winnow_fingerprints, chat_format.op8_chat_format, nbest_pieces.op9_nbest_pieces, bestfit.op10_bestfit_packing,
    )
    return {f.__name__: f for f in every} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op5_url_vocabulary": url_vocab.ORACLE, "op8_chat_format": chat_format.ORACLE}
