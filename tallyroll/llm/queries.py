"""The registered queries of this package and their SQL."""

from __future__ import annotations

from tallyroll.llm.best_fit import best_fit_packing
from tallyroll.llm.conversation_repair import conversation_repair
from tallyroll.llm.decontamination import decontamination
from tallyroll.llm.jaccard import jaccard
from tallyroll.llm.language import language
from tallyroll.llm.oracles import ORACLES as ORACLES
from tallyroll.llm.packing import packing
from tallyroll.llm.periodic_runs import runs
from tallyroll.llm.quality_crf import quality
from tallyroll.llm.quality_rules import quality_rules
from tallyroll.llm.repeats import repeats
from tallyroll.llm.shards import shards
from tallyroll.llm.token_files import token_files
from tallyroll.llm.toxicity import toxicity

QUERIES = {
    "op1_language": language,
    "op2_decontamination": decontamination,
    "op3_quality_rules": quality_rules,
    "op4_packing": packing,
    "op5_jaccard": jaccard,
    "op6_repeats": repeats,
    "op7_token_files": token_files,
    "op8_shards": shards,
    "op9_toxicity": toxicity,
    "op10_quality": quality,
    "op11_best_fit": best_fit_packing,
    "op12_conversations": conversation_repair,
    "op13_runs": runs,
}
