"""Independent DuckDB SQL for every registered query."""

from oracles.core import with_tables

__all__ = ["with_tables", "oracle_sql"]


def oracle_sql() -> dict[str, str]:
    from oracles import conversations, receivables, reports, streams, workflow

    out = {}
    for module in (receivables, reports, workflow, conversations, streams):
        for name, sql in module.SQL.items():
            if name in out:
                raise ValueError(f"oracle {name} is defined twice")
            out[name] = with_tables(sql)
    return out | {"management_report": with_tables(reports.management_report(receivables.SQL))}
