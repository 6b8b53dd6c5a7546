"""The registered training-data queries and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from eventsieve.llm import alignment, chat, classlm, decontaminate, embeddings, language, mixing, packing, periods, pii, simhash, suffixes, tokens


def queries() -> dict:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_token_counts": tokens.q_tokens,
        "op2_language_id": language.q_language,
        "op3_class_lm": classlm.q_class_lm,
        "op4_suffix_dedup": suffixes.q_suffixes,
        "op5_personal_data": pii.q_pii,
        "op6_decontamination": decontaminate.q_decontamination,
        "op7_simhash_near_dedup": simhash.q_simhash,
        "op8_mix_sources": mixing.q_mixing,
        "op9_embedding_near_dedup": embeddings.q_embeddings,
        "op10_chat_prefix_tree": chat.q_chat,
        "op11_tokenizer_alignment": alignment.q_alignment,
        "op12_periodic_runs": periods.q_periods,
        "op13_packing": packing.q_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_mix_sources": mixing.ORACLE_SQL, "op10_chat_prefix_tree": chat.ORACLE_SQL}
