"""The registered queries of the corpus operators, and the DuckDB text of those that SQL can express."""

from __future__ import annotations

from hiremill.llm.alignment import op11_alignment
from hiremill.llm.divergence import OP12_SQL, op12_divergence
from hiremill.llm.jaccard import op9_ngram_jaccard
from hiremill.llm.language import op10_language_id
from hiremill.llm.line_dedup import OP4_SQL, op4_line_dedup
from hiremill.llm.minhash import op13_minhash
from hiremill.llm.neighbours import op5_ann
from hiremill.llm.packing import op7_packing
from hiremill.llm.quality import op3_quality
from hiremill.llm.segmentation import op1_sentencepiece
from hiremill.llm.sharding import op2_sharding
from hiremill.llm.topk import OP6_SQL, op6_exact_topk
from hiremill.llm.toxicity import op8_toxicity

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_sharding": op2_sharding,
    "op3_quality": op3_quality,
    "op4_line_dedup": op4_line_dedup,
    "op5_ann": op5_ann,
    "op6_exact_topk": op6_exact_topk,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_language_id": op10_language_id,
    "op11_alignment": op11_alignment,
    "op12_divergence": op12_divergence,
    "op13_minhash": op13_minhash,
}

ORACLES: dict[str, str] = {"op4_line_dedup": OP4_SQL, "op6_exact_topk": OP6_SQL, "op12_divergence": OP12_SQL}
