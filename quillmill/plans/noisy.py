"""Documents with lines that cleaning and structure rules are for, made of documents by integer arithmetic alone, so that
Spark and SQL make the same. The plain documents hold next to none of them.

Line i of document d is rewritten by (31 d + 17 i) mod 23; most rewritten lines keep the beginning of the line.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

KINDS = 23
#: kind -> what the line becomes, as SQL that both engines read; x is the line, n its number from 0.
REWRITES = {
    0: "concat('# ', substring(x, 1, 40))",
    1: "concat('## ', substring(x, 1, 40))",
    2: "concat('### ', substring(x, 1, 40))",
    3: "concat('Page ', n, ' / 99')",
    4: "''",
    5: "concat('1.', n, ' ', substring(x, 1, 20), ' ..... ', n + 10)",
    6: "concat('Figure ', n, ' : ', substring(x, 1, 30))",
    7: "concat('Last update : ', substring(x, 1, 20))",
    8: "lower(substring(x, 1, 60))",
    9: "concat(substring(x, 1, 30), 'so-')",
    10: "concat('- ', substring(x, 1, 50))",
    11: "concat('Copyright 2020 ', substring(x, 1, 20))",
    12: "concat('Photo : ', substring(x, 1, 20))",
    13: "concat(chr(10), 'abc', chr(10))",
    14: "concat(substring(x, 1, 60), ' mail me@example.org or see https://example.org/a?b=1 there')",
    15: "'GENERAL TERMS AND CONDITIONS'",
    16: "concat('| ', substring(x, 1, 10), ' | ', n, ' |', chr(10), '| --- | --- |', chr(10))",
    17: "'The footer of every page'",
    18: "concat('10 [e] 5 m[2] **x** **[3]** ', substring(x, 1, 20))",
    19: "concat('☺ ', substring(x, 1, 30), '☺ ☺')",
    20: "concat('a  b   ', substring(x, 1, 20), '   ')",
    21: "'%%%% ++'",
    22: "concat('####   ', substring(x, 1, 12), '  and')",
}


def _case(number: str) -> str:
    forms = " ".join(f"WHEN {k} THEN {re.sub(r', n\b', f', {number}', sql)}" for k, sql in REWRITES.items())
    return f"CASE (doc_id * 31 + {number} * 17) % {KINDS} {forms} ELSE x END"


def noisy(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text)."""
    lines = f"transform(split(text, '\\n'), (x, n) -> {_case('n')})"
    return docs.select("doc_id", "source", F.expr(f"array_join({lines}, chr(10))").alias("text"))


#: The same as a CTE for DuckDB.
NOISY_SQL = f"noisy AS MATERIALIZED (SELECT doc_id, source, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: {_case('(i - 1)')}), chr(10)) AS text FROM documents)"
