"""The queries of this package, and SQL for those that SQL can express."""

import corpus_pipeline
from pageflow.llm import (
    bpe, decontamination, licenses, lm, mixing, mtree, near_dup, pii, quality, substrings, vector_codes, warc, whitening)

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_licenses": licenses.op1_licenses, "op2_quality": quality.op2_quality, "op3_near_dup": near_dup.op3_near_dup, "op4_warc": warc.op4_warc,
    "op5_mixing": mixing.op5_mixing, "op6_bpe": bpe.op6_bpe, "op7_pii": pii.op7_pii, "op8_lm": lm.op8_lm,
    "op9_mtree": mtree.op9_mtree, "op10_substrings": substrings.op10_substrings,
    "op11_decontamination": decontamination.op11_decontamination, "op12_whitening": whitening.op12_whitening,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}
SQL = {"op3_near_dup": near_dup.OP3_SQL, "op4_warc": warc.OP4_SQL, "op9_mtree": mtree.OP9_SQL,
       "op10_substrings": substrings.OP10_SQL, "op11_decontamination": decontamination.OP11_SQL, "op13_vector_codes": vector_codes.OP13_SQL}
