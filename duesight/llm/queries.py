"""Registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from .bpe import op2_bpe
from .fingerprints import op3_imatch
from .knn import OP6_SQL, op6_voronoi
from .langid import op9_language
from .lines import op4_fuzzy_lines
from .manifest import OP13_SQL, op13_merkle_manifest
from .ngram_join import OP5_SQL, op5_ngram_join
from .packing import op7_packing
from .periodic import op11_periodic_runs
from .pii import op1_pii
from .quality import op10_quality
from .secret_scan import op8_secrets
from .url_filter import OP12_SQL, op12_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_bpe,
        op3_imatch,
        op4_fuzzy_lines,
        op5_ngram_join,
        op6_voronoi,
        op7_packing,
        op8_secrets,
        op9_language,
        op10_quality,
        op11_periodic_runs,
        op12_url_filter,
        op13_merkle_manifest,
    )
}
ORACLES = {"op5_ngram_join": OP5_SQL, "op6_voronoi": OP6_SQL, "op12_url_filter": OP12_SQL, "op13_merkle_manifest": OP13_SQL}
