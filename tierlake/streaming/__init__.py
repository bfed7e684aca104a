from tierlake.streaming.admission import admit_arrivals, distinct_arrivals, with_source_file
from tierlake.streaming.arrivals import upsert_arrivals

__all__ = ["admit_arrivals", "distinct_arrivals", "upsert_arrivals", "with_source_file"]
