"""Reusable DataFrame operators the analyses are composed of."""

from newsatlas.operators.joins import heavy_keys, lookup_few, spread_join
from newsatlas.operators.lists import explode_delimited
from newsatlas.operators.pairs import unordered_pairs
from newsatlas.operators.ranking import latest_per_key, top_n, top_n_per_group
from newsatlas.operators.roles import unpivot_roles
from newsatlas.operators.series import following, moving_average, previous, rolling_sum
from newsatlas.operators.shape import as_text
from newsatlas.operators.views import (
    all_columns,
    bar_chart,
    bar_colours,
    country_map,
    drop_repeats,
    map_scale,
    numeric_columns,
    shown_and_total,
)

__all__ = [name for name in dir() if not name.startswith("_")]
