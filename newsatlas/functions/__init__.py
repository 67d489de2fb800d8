"""Column builders: every one is a composition of Spark's own expressions."""

from newsatlas.functions.actors import CATEGORY_CODES, actor_category
from newsatlas.functions.aggregates import (
    combined_moments,
    count_where,
    distinct_sketch,
    entropy,
    mean,
    mean_of,
    merged_sketches,
    moments,
    pearson,
    pearson_of,
    percent_of,
    ratio,
    sketch_estimate,
)
from newsatlas.functions.parsing import (
    day_text,
    delimited,
    feed_date,
    feed_timestamp,
    feed_timestamp_prefix,
    feed_year,
    field,
    leading_item,
    mention_time_text,
    not_blank,
    number_text,
    safe_float,
    slice_start,
    strict_number,
    trim_all,
)
from newsatlas.functions.regions import (
    NO_REGION,
    REGION_CODES,
    region_of,
    register_region_function,
)

__all__ = [name for name in dir() if not name.startswith("_")]
