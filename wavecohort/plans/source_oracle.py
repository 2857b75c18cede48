"""DuckDB SQL for the source results (``sources.planted``)."""

from __future__ import annotations

from ..sources import planted as PL
from ..sources.panel import PANEL_SCHEMA
from .oracle import _q, cte

cte("planted", ("panel",), f"""
select *, cast(hhidpn // {PL.PERSONS_PER_FILE} as int) as block, {PL.KIND} as kind,
  row_number() over (partition by hhidpn // {PL.PERSONS_PER_FILE} order by hhidpn, wave) as row
from panel""")


def _text(value: str | None) -> str:
    return "cast(null as varchar)" if value is None else _q(value)


cte("planted_faults", ("planted",), "\nunion all\n".join(
    f"select block, row, {_text(col)} as col, {_q(expected)} as expected, {_q(actual)} as actual from planted where kind = {k}"
    for k, (col, expected, actual) in PL.FAULTS.items()
))


def _planted_column(name: str) -> str:
    kind = next((k for k, (col, _, _) in PL.FAULTS.items() if col == name), 1 if name == PANEL_SCHEMA.names[-1] else None)
    return f'"{name}"' if kind is None else f'case when kind <> {kind} then "{name}" end as "{name}"'


cte("planted_panel", ("planted",), "select " + ", ".join(map(_planted_column, PANEL_SCHEMA.names)) + ", case " + " ".join(
    f"when kind = {k} then {_q(text)}" for k, text in PL.REMARKS.items()
) + " end as remark from planted")

_LOGICAL = "('T', 'TRUE', 'true', 'True', 'F', 'FALSE', 'false', 'False')"


def _column_type(name: str, e: str) -> str:
    return f"""
select '{name}' as "column", case when count(v) = 0 then 'null'
    when bool_and(v in {_LOGICAL}) then 'logical'
    when bool_and(not contains(v, '.') and not contains(v, 'e') and try_cast(v as bigint) is not null) then 'integer'
    when bool_and(try_cast(v as double) is not null) then 'double'
    when bool_and(try_cast(v as date) is not null) then 'date' else 'text' end as type,
  count(v) as n_values, count(*) - count(v) as n_missing
from (select cast({e} as varchar) as v from panel)"""


cte("column_types", ("panel",), "\nunion all".join(_column_type(n, e) for n, e in PL.MIXED_TEXT.items()))
