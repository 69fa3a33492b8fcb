"""Small helpers that put the oracle SQL texts together."""

from __future__ import annotations

from .roles import ctes

AS_OF = "date '2001-08-01'"
AFTER = "date '1994-12-31'"
YEAR_END = "date '2001-12-31'"
# Word lists that must equal the business rules.
SVC = "('annual maintenance', 'service opportunity', 'added protection')"
FIELD = "('new', 'rehash', 'reset', 'radon crm pickup')"
SETS = "('new', 'reset', 'radon crm pickup')"
EXSRC = "('annual maintenance', 'service opportunity', 'existing database', 'service')"
VISIT = "('wcc', 'service opportunity', 'sanidry return')"


def days(through: str = AS_OF, after: str = AFTER) -> str:
    return (f"select cast(d as date) as date from range({after} + interval 1 day, "
            f"{through} + interval 1 day, interval 1 day) t(d)")


def sql(roles: list[str], steps: dict[str, str], select: str, ints: str = "", doubles: str = "", keys: str = "",
        digits: int = 4) -> str:
    """``WITH`` roles and steps; the final select types its columns as key, bigint or rounded double."""
    parts = ctes(roles) + [f"{n} as ({q.strip()})" for n, q in steps.items()]
    out = [k for k in keys.split()]
    out += [f"cast({i} as bigint) as {i}" for i in ints.split()]
    out += [f"cast(round(cast({d} as decimal(30,8)), {digits}) as double) as {d}" for d in doubles.split()]
    head = ("with " + ",\n".join(parts) + "\n") if parts else ""
    return f"{head}select {', '.join(out)}\nfrom ({select.strip()}) final_rows"


def folded(src: str, keys: str, sums: str, exact: str = "date") -> str:
    """Group without regard to case, showing the smallest spelling."""
    ks, ss, es = keys.split(), sums.split(), exact.split()
    cols = [f"x.{e}" for e in es] + [f"min(x.{k}) as {k}" for k in ks] + [f"sum(x.{s}) as {s}" for s in ss]
    group = [f"x.{e}" for e in es] + [f"lower(x.{k})" for k in ks]
    return f"select {', '.join(cols)} from {src} x group by {', '.join(group)}"


def on_calendar(src: str, keys: str, sums: str, through: str = AS_OF, exact: str = "") -> str:
    """Calendar left join, then group without regard to case."""
    ks, ss, es = keys.split(), sums.split(), exact.split()
    cols = ["d.date"] + [f"x.{e}" for e in es] + [f"min(x.{k}) as {k}" for k in ks] + [f"sum(x.{s}) as {s}" for s in ss]
    group = ["d.date"] + [f"x.{e}" for e in es] + [f"lower(x.{k})" for k in ks]
    return (f"select {', '.join(cols)} from ({days(through)}) d left join {src} x on d.date = x.date "
            f"group by {', '.join(group)}")
