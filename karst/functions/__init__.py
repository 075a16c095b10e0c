from karst.functions.expressions import bind, col, divide, isin, isnotnull, isnull, lit, notiin
from karst.functions.json_paths import (array_has, json_array_has, json_contains, json_get_bool,
                                        json_get_float, json_get_int, json_get_str)

__all__ = ["bind", "col", "lit", "divide", "isnull", "isnotnull", "isin", "notiin", "array_has",
           "json_get_str", "json_get_int", "json_get_float", "json_get_bool", "json_contains",
           "json_array_has"]
