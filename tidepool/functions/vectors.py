"""Vector and labeled-point text forms (PRJ9, PRJ10) as column expressions.

Accepted forms, as in the reference's input files and its parsers:
  * dense vector   ``[a,b,...]``
  * sparse vector  ``(size,[i,...],[a,...])``
  * labeled point  ``(label,vector)`` with either vector
  * legacy labeled point ``label,x1 x2 ...`` (fields after the second are ignored)
Lines may end in CR (the files are CRLF). Malformed input, also junk after a
valid form, yields NULL fields and ``parse_ok = false`` instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepool.functions.text import java_trim

_NUMBER = r"[-+]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?|NaN|Infinity)"
_LIST = rf"\[\s*(?:{_NUMBER}(?:\s*,\s*{_NUMBER})*)?\s*\]"
_DENSE = rf"^({_LIST})$"
_SPARSE = rf"^\(\s*([0-9]+)\s*,\s*(\[\s*(?:[0-9]+(?:\s*,\s*[0-9]+)*)?\s*\])\s*,\s*({_LIST})\s*\)$"
_POINT = rf"^\(\s*({_NUMBER})\s*,\s*(.*)\)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _numbers(text: Column, kind: str = "double") -> Column:
    """``[a, b]`` -> array."""
    inner = F.regexp_replace(text, r"[\[\]\s]", "")
    return F.when(inner == "", F.array().cast(f"array<{kind}>")).otherwise(
        F.transform(F.split(inner, ","), lambda x: x.try_cast(kind)))


def parse_vector(line) -> Column:
    """A dense or sparse vector -> ``array<double>``; NULL when malformed."""
    s = java_trim(_col(line))
    places = _numbers(F.regexp_extract(s, _SPARSE, 2), "int")
    values = _numbers(F.regexp_extract(s, _SPARSE, 3))
    size = F.regexp_extract(s, _SPARSE, 1).try_cast("int")
    at = lambda i: F.array_position(places, i).cast("int")
    filled = F.when(size == 0, F.array().cast("array<double>")).otherwise(F.transform(
        F.sequence(F.lit(0), size - 1), lambda i: F.coalesce(F.get(values, at(i.cast("int")) - 1), F.lit(0.0))))
    fits = (F.size(places) == F.size(values)) & (F.coalesce(F.array_max(places), F.lit(-1)) < size)
    return (F.when(s.rlike(_DENSE), _numbers(F.regexp_extract(s, _DENSE, 1)))
             .when(s.rlike(_SPARSE) & fits, filled))


def parse_labeled_point(line) -> Column:
    """Struct ``(label double, features array<double>, parse_ok boolean)``."""
    s = java_trim(_col(line))
    is_tuple = s.startswith("(")
    t_label = F.regexp_extract(s, _POINT, 1).try_cast("double")
    t_feats = parse_vector(F.regexp_extract(s, _POINT, 2))
    fields = F.split(s, ",")
    l_label = F.trim(fields[0]).try_cast("double")
    l_feats = F.when(F.size(fields) > 1,
                     F.transform(F.split(F.trim(fields[1]), " +"), lambda x: x.try_cast("double")))
    label = F.when(is_tuple, t_label).otherwise(l_label)
    feats = F.when(is_tuple, t_feats).otherwise(l_feats)
    ok = (label.isNotNull() & feats.isNotNull()
          & F.coalesce(F.forall(feats, lambda x: x.isNotNull()), F.lit(False)))
    return F.struct(label.alias("label"), feats.alias("features"), ok.alias("parse_ok"))
