"""Building blocks of the checking SQL: bound tables as CTEs, exact rounding, output casts."""

from __future__ import annotations

import re

from tidemark.sources.bindings import SELECTS

CTES: dict[str, str] = {name: re.sub(r"\{(\w+)\}", r"\1", text) for name, text in SELECTS.items()}

# Driver tables keep their own names inside a CTE of the same name, so none of ours may shadow them.
CTES["latest"] = """SELECT unnest(pick), 1 rn FROM (SELECT arg_max(s, {'d': subscription_start_date, 'i': subscription_id}) pick
 FROM subscriptions s GROUP BY customer_id)"""
CTES["spend_by_customer"] = """SELECT customer_id, COALESCE(paid,0) clv FROM customers LEFT JOIN
 (SELECT customer_id, SUM(amount) paid FROM payments WHERE payment_status='Success' GROUP BY 1) USING(customer_id)"""
CTES["watch_months"] = """SELECT customer_id, CAST(date_trunc('month',viewing_date) AS DATE) AS month,
 CAST(SUM(watch_duration_minutes) AS BIGINT) watch_minutes FROM viewing_activity GROUP BY 1,2"""


def _needed(text: str, found: list[str]) -> list[str]:
    for name in CTES:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(CTES[name], found)
            if name not in found:
                found.append(name)
    return found


def sql(body: str) -> str:
    """Prefix the CTEs that the body names, in dependency order."""
    body = body.strip()
    names = _needed(body, [])
    head = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in names)
    if not head:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def half_up(num: str, den: str, digits: int = 2) -> str:
    """Exact num/den of integers, rounded half away from zero."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    scale = 10 ** digits
    return (f"(CASE WHEN ({d})=0 THEN NULL ELSE sign({n})*CAST((2*{scale}*abs({n})+{d})//(2*{d}) AS DOUBLE)/{scale} END)")


def half_even(num: str, den: str, digits: int = 2) -> str:
    """Exact num/den of non-negative integers, rounded half to even."""
    scale = 10 ** digits
    n, d = f"(CAST({num} AS HUGEINT)*{scale})", f"CAST({den} AS HUGEINT)"
    q, r = f"({n}//{d})", f"({n}%{d})"
    return (f"(CASE WHEN {d}=0 THEN NULL ELSE CAST({q}+CASE WHEN 2*{r}>{d} OR (2*{r}={d} AND {q}%2=1) "
            f"THEN 1 ELSE 0 END AS DOUBLE)/{scale} END)")


def mean(c: str, digits: int = 2, units: int = 1, where: str = "") -> str:
    """Average of a column that becomes an integer when multiplied by ``units``."""
    f = f" FILTER(WHERE {where})" if where else ""
    return half_up(f"SUM(CAST({c}*{units} AS BIGINT)){f}", f"COUNT({c}){f}*{units}", digits)


def day(c: str) -> str:
    return f"strftime({c},'%Y-%m-%d')"


def num(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def big(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


MONTH = "CAST(date_trunc('month',{0}) AS DATE)".format
