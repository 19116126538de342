"""The few expressions Spark SQL and DuckDB spell differently."""

from __future__ import annotations


class SparkSQL:
    # Cut from the text form: date_format would pass wall-clock times through the session zone.
    month_formats = {"Mon-Y": "MMM-yyyy", "MonY": "MMMyyyy", "Mon Y": "MMM yyyy"}

    def fmt(self, x, name):
        if name in self.month_formats:
            return f"date_format({x}, '{self.month_formats[name]}')"
        text = f"CAST({x} AS STRING)"
        day = f"substr({text}, 1, 10)"
        if name.startswith("mdy"):
            day = f"substr({text}, 6, 2) || '/' || substr({text}, 9, 2) || '/' || substr({text}, 1, 4)"
        twelve = f"lpad(CAST((hour({x}) + 11) % 12 + 1 AS STRING), 2, '0')"
        half = f"CASE WHEN hour({x}) < 12 THEN ' AM' ELSE ' PM' END"
        clock = {"hms": f" || substr({text}, 11, 9)", "hm": f" || substr({text}, 11, 6)",
                 "hms p": f" || ' ' || {twelve} || substr({text}, 14, 6) || {half}", "": ""}
        return f"({day}{clock[name[4:]]})"

    def pick(self, items, i):
        at = f"element_at(array({', '.join(items)}), CAST({i} AS INT) + 1)"
        if not any("(" in item for item in items):
            return at  # a constant array
        # An array computes all its items; this computes the one that is taken.
        cases = " ".join(f"WHEN {k} THEN {item}" for k, item in enumerate(items))
        return f"CASE CAST({i} AS INT) {cases} ELSE {at} END"

    def plus_minutes(self, ts, m):
        return f"({ts} + make_dt_interval(0, 0, CAST({m} AS INT), 0))"

    def plus_months(self, d, n):
        return f"add_months({d}, {n})"

    def month(self, d):
        return f"trunc({d}, 'MM')"

    def thousands(self, x):
        return f"format_number({x}, 0)"

    def serial(self, d):
        return f"CAST(datediff({d}, DATE '1899-12-30') AS STRING)"

    def months(self, first, last):
        return (f"SELECT explode(sequence(DATE '{first}', DATE '{last}', INTERVAL 1 MONTH))"
                " AS delivery_month")

    def plus_days(self, d, n):
        return f"date_add({d}, CAST({n} AS INT))"

    def json_number(self, x, key):
        return f"CAST(get_json_object({x}, '$.{key}') AS DOUBLE)"


class DuckSQL(SparkSQL):
    formats = {
        "ymd": "%Y-%m-%d", "mdy": "%m/%d/%Y",
        "ymd hms": "%Y-%m-%d %H:%M:%S", "ymd hm": "%Y-%m-%d %H:%M",
        "ymd hms p": "%Y-%m-%d %I:%M:%S %p", "mdy hms": "%m/%d/%Y %H:%M:%S",
        "Mon-Y": "%b-%Y", "MonY": "%b%Y", "Mon Y": "%b %Y",
    }

    def fmt(self, x, name):
        return f"strftime({x}, '{self.formats[name]}')"

    def pick(self, items, i):
        return f"list_extract([{', '.join(items)}], CAST({i} AS INT) + 1)"

    def plus_minutes(self, ts, m):
        return f"({ts} + to_minutes(CAST({m} AS BIGINT)))"

    def plus_months(self, d, n):
        return f"CAST({d} + to_months(CAST({n} AS INT)) AS DATE)"

    def month(self, d):
        return f"CAST(date_trunc('month', {d}) AS DATE)"

    def thousands(self, x):
        return f"format('{{:,}}', CAST({x} AS BIGINT))"

    def serial(self, d):
        return f"CAST(datediff('day', DATE '1899-12-30', {d}) AS VARCHAR)"

    def months(self, first, last):
        return (f"SELECT CAST(unnest(generate_series(DATE '{first}', DATE '{last}',"
                " INTERVAL 1 MONTH)) AS DATE) AS delivery_month")

    def plus_days(self, d, n):
        return f"CAST({d} + to_days(CAST({n} AS INT)) AS DATE)"

    def json_number(self, x, key):
        return f"CAST(regexp_extract({x}, '\"{key}\": ([0-9]+)', 1) AS DOUBLE)"


SPARK, DUCK = SparkSQL(), DuckSQL()
