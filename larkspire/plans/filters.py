"""Typed filters: a field, an operator and a literal that says its type, so that a query written down means the same anywhere."""

from __future__ import annotations

import base64
import ipaddress
from datetime import datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

OPERATORS = {"eq": lambda c, v: c == v, "neq": lambda c, v: c != v, "lt": lambda c, v: c < v, "lte": lambda c, v: c <= v, "gt": lambda c, v: c > v, "gte": lambda c, v: c >= v}
INTEGERS = {f"{sign}{bits}": (0 if sign == "u" else -(1 << bits - 1), (1 << (bits if sign == "u" else bits - 1)) - 1) for sign in "iu" for bits in (8, 16, 32, 64)}
#: Units of a time's count, in microseconds.
TIMES = {"ts_s": 1_000_000, "ts_ms": 1000, "ts_us": 1, "ts_ns": 0.001}


def typed(field: str, op: str, value: object, value_type: str | None = None) -> dict:
    """The filter for a Python value; its type is guessed if it isn't given."""
    if value_type is None:
        kinds = ((bool, "bool"), (int, "i64"), (float, "f64"), (str, "utf8"), (bytes, "binary"), (datetime, "ts_us"))
        value_type = next((name for kind, name in kinds if isinstance(value, kind)), None)
        if value_type == "i64" and value > INTEGERS["i64"][1]:
            value_type = "u64"
    if isinstance(value, bytes):
        value = base64.b64encode(value).decode()
    elif isinstance(value, datetime):
        value = (value.replace(tzinfo=None) - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    made = {"field": field, "op": op, "value": value, "value_type": value_type}
    condition(made)
    return made


def literal(value: object, value_type: str) -> Column:
    if value_type in INTEGERS:
        low, high = INTEGERS[value_type]
        if isinstance(value, bool) or int(value) != value or not low <= value <= high:
            raise ValueError(f"{value!r} is no {value_type}")
        return F.lit(Decimal(int(value))) if value > INTEGERS["i64"][1] else F.lit(int(value)).cast("bigint")
    if value_type in ("f32", "f64"):
        return F.lit(float(value)).cast("float" if value_type == "f32" else "double")
    if value_type == "bool" and isinstance(value, bool) or value_type == "utf8" and isinstance(value, str):
        return F.lit(value)
    if value_type == "ip":
        address = ipaddress.ip_address(value)  # an IPv4 address in its IPv6 form is the IPv4 address
        return F.lit(str(getattr(address, "ipv4_mapped", None) or address))
    if value_type == "binary":
        return F.lit(base64.b64decode(value, validate=True))
    unit, _, zone = str(value_type).partition(":")  # a zone says how the time was written; the count is of UTC either way
    if unit in TIMES:
        micros = int(value) // 1000 if unit == "ts_ns" else int(value) * TIMES[unit]
        return F.lit(datetime(1970, 1, 1) + timedelta(microseconds=micros)).cast("timestamp_ntz") if not zone else F.lit(datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros))
    raise ValueError(f"no literal {value!r} of type '{value_type}'")


def condition(filter_: str | Column | dict) -> str | Column:
    """What DataFrame.where() takes."""
    if not isinstance(filter_, dict):
        return filter_
    if filter_.keys() != {"field", "op", "value", "value_type"}:
        raise ValueError("a typed filter has field, op, value and value_type")
    if filter_["op"] not in OPERATORS:
        raise ValueError(f"unknown operator '{filter_['op']}'")
    return OPERATORS[filter_["op"]](F.col(f"`{filter_['field']}`"), literal(filter_["value"], filter_["value_type"]))
