from ferrite.functions.exprs import (  # noqa: F401
    attach_one_row, decide, hash_key, hash_unit, ratio, relative_saving, risk_tier, strip_prefixes,
)
