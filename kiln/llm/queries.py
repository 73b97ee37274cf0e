"""Queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from .ann import op10_ann
from .bpe import op2_bpe_codec
from .imatch import op6_imatch
from .lexical import OP12_SQL, op12_lexical_search
from .line_dedup import OP11_SQL, op11_line_dedup
from .mixing import OP5_SQL, op5_mix_sources
from .ngram_join import OP4_SQL, op4_ngram_join
from .pii import op8_pii
from .quality import op1_quality
from .secrets import op9_secret_scan
from .spelling import OP13_SQL, op13_spelling_variants
from .token_files import op3_token_files
from .warc import OP7_SQL, op7_warc

QUERIES = {
    "op1_quality": op1_quality,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_token_files": op3_token_files,
    "op4_ngram_join": op4_ngram_join,
    "op5_mix_sources": op5_mix_sources,
    "op6_imatch": op6_imatch,
    "op7_warc": op7_warc,
    "op8_pii": op8_pii,
    "op9_secret_scan": op9_secret_scan,
    "op10_ann": op10_ann,
    "op11_line_dedup": op11_line_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL = {
    "op4_ngram_join": OP4_SQL,
    "op5_mix_sources": OP5_SQL,
    "op7_warc": OP7_SQL,
    "op11_line_dedup": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_spelling_variants": OP13_SQL,
}
