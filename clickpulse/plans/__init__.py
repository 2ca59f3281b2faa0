from clickpulse.plans.sliding import window_counts, tumbling_bounds, floor_div
from clickpulse.plans.chunks import with_halo, halo_copies, running_by_chunk, chunk_width
from clickpulse.plans.skew import salted_count
from clickpulse.plans.iterate import cut_lineage
from clickpulse.plans.chains import reached
from clickpulse.plans.names import unused

__all__ = ["window_counts", "tumbling_bounds", "floor_div", "with_halo", "halo_copies", "running_by_chunk",
           "chunk_width", "salted_count", "cut_lineage", "reached", "unused"]
