from attrition.functions.exprs import (  # noqa: F401
    cents,
    r6,
    safe_ratio,
    sigmoid,
)
