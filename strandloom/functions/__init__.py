"""Column functions that users combine freely, gathered from the operator modules."""

from ..operators.intervals import distance_class, distance_to, overlap_bp, overlap_type
from ..operators.matrix import log_shift, pair_condition
from ..operators.methylation import call_methylation, consecutive_calls, nonconversion_calls, rgb_by_percent, sequence_context
from ..operators.reads import cigar_ref_length, has_flag, umi_from_name
from ..operators.sequence import iupac_regex, reverse_complement
from ..operators.sets import psi
from ..operators.stats import chi_square_p, correlation_p, fisher_exact, hypergeometric_tail, volcano_class

__all__ = [n for n in dir() if not n.startswith("_") and n not in ("operators",)]
