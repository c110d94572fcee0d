"""DataFrame operators."""

from barfold.operators.catch_up import price_catch_up, price_changes, refresh_prices
from barfold.operators.dictionary import (
    encode_enums,
    encode_enums_at_once,
    enums_of,
    extend_enum,
    extend_enums,
    extend_enums_at_once,
)
from barfold.operators.levels import price_history, reconstruct, roundtrip_diff
from barfold.operators.lookups import get_return, last_date, max_date, param_query
from barfold.operators.maintain import (
    delete_matching,
    drop_unchanged,
    insert_absent,
    one_per_key,
    replace_by,
    upsert,
)
from barfold.operators.ordered import aggregate_up_to, asof, drop_unchanged_append
from barfold.operators.returns import (
    by_security,
    last_price,
    last_volume,
    price_returns,
    returns,
    returns_revised,
    volume_returns,
)

__all__ = [
    "aggregate_up_to",
    "asof",
    "by_security",
    "delete_matching",
    "drop_unchanged",
    "drop_unchanged_append",
    "encode_enums",
    "encode_enums_at_once",
    "enums_of",
    "extend_enum",
    "extend_enums",
    "extend_enums_at_once",
    "get_return",
    "insert_absent",
    "last_date",
    "last_price",
    "last_volume",
    "max_date",
    "one_per_key",
    "param_query",
    "price_catch_up",
    "price_changes",
    "price_history",
    "price_returns",
    "reconstruct",
    "refresh_prices",
    "replace_by",
    "returns",
    "returns_revised",
    "roundtrip_diff",
    "upsert",
    "volume_returns",
]
