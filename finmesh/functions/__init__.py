"""Column functions: each takes and returns a ``pyspark.sql.Column``."""
from finmesh.functions.text import (  # noqa: F401
    split_plain, split_comma_nospace, strip_ws, clean_items, lower_items,
)
from finmesh.functions.coerce import (  # noqa: F401
    parse_date, parse_int_number, parse_decimal, parse_int_id, truthy,
    allocated_amount, percent_complete,
)
from finmesh.functions.nested import first_nested_value, first_of_nested, json_field  # noqa: F401
