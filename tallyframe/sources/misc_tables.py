"""Page-rank, visit and run-log tables built from ``pages`` and ``events``."""

from __future__ import annotations

from tallyframe.sources.wording import columns, idiv

_RUN = idiv("event_id", 100)

TABLES: dict[str, str] = {
    "rankings": "select " + columns({
        "pageURL": ("string", "url"),
        "pageRank": ("int", "length(html) % 1500"),
        "avgDuration": ("int", "length(url)"),
    }) + " from {pages}",
    # Visits land on a page by key; page keys count up from 0.
    "uservisits": "select " + columns({
        "sourceIP": ("string", "concat(cast(user_id % 223 + 1 as string), '.', cast((user_id * 7) % 256 as string), '.', cast(event_id % 256 as string), '.', cast((event_id * 3) % 256 as string))"),
        "destURL": ("string", "p.url"),
        "visitDate": ("date", f"date '1980-01-01' + cast({idiv('event_id * 131', 7)} % 9000 as int)"),
        "adRevenue": ("decimal(12,2)", "e.value"),
    }) + " from (select *, event_id % (select count(*) from {pages}) as landing from {events}) e join {pages} p on e.landing = p.page_id",
    # One timed result per event: the query is the event type; 25 results make an iteration, four iterations a run.
    "timings": "select " + columns({
        "run_ms": ("bigint", f"1704067200000 + {_RUN} * 3600000"),
        "iteration": ("int", f"{idiv('event_id', 25)} % 4 + 1"),
        "version": ("string", f"case {_RUN} % 3 when 0 then '3.0.0-SNAPSHOT' when 1 then '3.1.0' else '4.1.0' end"),
        "run_type": ("string", f"case when {_RUN} % 10 = 9 then 'adhoc' else 'daily' end"),
        "database": ("string", f"case {_RUN} % 2 when 0 then 'tpcds1500' else 'tpcds100' end"),
        "name": ("string", "event_type"),
        "seed": ("int", "event_id % 3"),
        "parsing": ("bigint", "event_id % 37"),
        "analysis": ("bigint", "event_id % 113 + 5"),
        "optimization": ("bigint", "event_id % 71 + 3"),
        "planning": ("bigint", "event_id % 53 + 2"),
        "execution": ("bigint", "cast(round(value * 100) as bigint) + 500"),
        "failed": ("boolean", "event_id % 97 = 5"),
        "seq": ("bigint", "event_id"),
    }) + " from {events}",
    # Stack samples: caller and callee lines, one host per user group.
    "samples": "select " + columns({
        "caller": ("string", "concat('org.engine.Runner.run(Runner.scala:', cast(user_id % 9 + 10 as string), ')')"),
        "callee": ("string", "concat('org.engine.tasks.Task', event_type, '.call(', event_type, '.scala)')"),
        "host": ("string", "concat('node', cast(user_id % 7 as string))"),
    }) + " from {events}",
    # Bytes of a workload's input.
    "object_sizes": "select event_type as name, cast(sum(length(props)) as bigint) as bytes from {events} where event_type <> 'error' group by event_type",
}
