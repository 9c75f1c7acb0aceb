"""DataFrame -> DataFrame operators."""

from histmart.operators.series import (
    pair_array, explode_pairs, text_to_tokens, channel_array, explode_channels,
    PRICE_CHANNELS, RANK_CHANNEL, RATING_CHANNEL, REVIEW_COUNT_CHANNEL,
)
from histmart.operators.flatten import SPREAD, flatten, flatten_variant, inline_dealt, tagged_assets
from histmart.operators.dedup import (
    order_col, latest_per_key, last_of_day, first_by_value, lag_parent, previous_in_array,
)
from histmart.operators.joins import full_outer_series, left_enrich_latest, offset_self_join

__all__ = [
    "pair_array", "explode_pairs", "text_to_tokens", "channel_array", "explode_channels",
    "PRICE_CHANNELS", "RANK_CHANNEL", "RATING_CHANNEL", "REVIEW_COUNT_CHANNEL",
    "SPREAD", "flatten", "flatten_variant", "inline_dealt", "tagged_assets",
    "order_col", "latest_per_key", "last_of_day", "first_by_value", "lag_parent",
    "previous_in_array",
    "full_outer_series", "left_enrich_latest", "offset_self_join",
]
