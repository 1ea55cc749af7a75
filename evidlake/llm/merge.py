"""Three-way merge of two branches of a table, as one SQL statement.

Each branch edits the base by a rule: every unit of a row (the row itself, a column, a line of its text) has the code
crc32(``branch:key:name``) modulo ``modulus``, where ``name`` is ``row``, the column's name or the line's number.

* code 0 drops the row or the line, and makes a column empty;
* lines and columns: 1 appends ``!``, 2 appends ``?``;
* lines: 3 inserts the line ``!`` after it, 4 the line ``?``;
* rows: 3 adds a row with text ``!`` and the row's own columns, 4 one with text ``?``, under the key -1-key (left) or -2-key (right).

The text is split at line feeds and exploded with positions: columns, lines and the gap after each line are units, rows of
one table. Each branch's state of a unit comes from its code, CASE merges the two states, and an ordered ``collect_list``
puts the lines that remain together again, beside sums of what was merged and what was in conflict. A unit that one branch
changed, or both alike, is one clean merge; a unit that both changed otherwise is one conflict and keeps the base's state.
A row that one branch drops is gone and counts one clean merge, if the other branch drops it too or leaves it as it is; else
it stays as in the base and counts one edit-delete conflict and nothing else. Added rows are merged by their key and value.

Every exchange is by a row's own number or by the key of an added row. Units are pre-aggregated where their row was read,
so a row of the exchange is a document, not a line, and no join can become a broadcast.

Defined cases: nulls become empty first (an empty text is one empty line, no line left is an empty text). A null key counts as
an empty name and stays null; it adds no rows, and neither does one whose new key is no long. Rows with one key are merged one
by one; if they add several values under one key, the branches agree when their sets of values do, all of these are kept, and each
counts one clean merge. A key that the base holds already is not added. An empty table gives an empty one. Very long texts need
the memory of one text. Only key, text and the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODULUS = 11


def _code(branch: str, name: str, modulus: int) -> str:
    return f"crc32(CAST(concat('{branch}:', coalesce(CAST(id AS STRING), ''), ':', {name}) AS BINARY)) % {modulus}"


def _rows(n: int, branches: tuple[str, str], names: tuple[str, ...], modulus: int) -> str:
    """SQL: the rows of the base, merged. Columns are c0, c1, ... here; positions below ``n`` are columns, then lines and gaps alternate."""
    left, right = branches
    name = "CASE " + " ".join(f"WHEN pos = {i} THEN '{c}'" for i, c in enumerate(names)) + f" ELSE CAST((pos - {n}) DIV 2 AS STRING) END"
    state = "CASE kind WHEN 'gap' THEN CASE {0} WHEN 3 THEN '!' WHEN 4 THEN '?' END ELSE CASE {0} WHEN 0 THEN CASE kind WHEN 'column' THEN '' END WHEN 1 THEN concat(v, '!') WHEN 2 THEN concat(v, '?') ELSE v END END"
    cells = ", ".join(f"c{i}" for i in range(n))
    kept = ", ".join(f"max(CASE WHEN pos = {i} THEN v END) AS base{i}, max(CASE WHEN pos = {i} THEN m END) AS c{i}" for i in range(n))
    shown = ", ".join(f"CASE WHEN conflict THEN base{i} WHEN NOT gone THEN c{i} END AS c{i}" for i in range(n))
    alone = ", ".join(f"CASE WHEN conflict OR gone THEN {x} ELSE {c} END AS {c}" for x, c in (("CAST(gone AS LONG)", "n_clean"), ("0", "n_edit_edit"), ("CAST(conflict AS LONG)", "n_edit_delete"), ("0", "n_insert_insert")))
    return f"""
WITH base AS (SELECT monotonically_increasing_id() AS rid, * FROM {{docs}}),
units AS (
  SELECT rid, id, {_code(left, "'row'", modulus)} = 0 AS drop_l, {_code(right, "'row'", modulus)} = 0 AS drop_r, pos, v,
         CASE WHEN pos < {n} THEN 'column' WHEN (pos - {n}) % 2 = 0 THEN 'line' ELSE 'gap' END AS kind
  FROM base LATERAL VIEW posexplode(concat(array({cells}), flatten(transform(split(text, '\\n'), x -> array(x, CAST(NULL AS STRING)))))) AS pos, v),
named AS (SELECT *, {name} AS name FROM units),
coded AS (SELECT *, {_code(left, "name", modulus)} AS code_l, {_code(right, "name", modulus)} AS code_r FROM named),
states AS (SELECT rid, id, drop_l, drop_r, pos, kind, v, {state.format("code_l")} AS l, {state.format("code_r")} AS r FROM coded),
merged AS (
  SELECT *, NOT l <=> v AS new_l, NOT r <=> v AS new_r, NOT l <=> v AND NOT r <=> v AND NOT l <=> r AS clash,
         CASE WHEN l <=> r OR r <=> v THEN l WHEN l <=> v THEN r ELSE v END AS m
  FROM states),
regrouped AS (
  SELECT id, drop_l, drop_r, bool_or(new_l) AS any_l, bool_or(new_r) AS any_r,
         count_if((new_l OR new_r) AND NOT clash) AS n_clean,
         count_if(clash AND kind <> 'gap' AND l IS NOT NULL AND r IS NOT NULL) AS n_edit_edit,
         count_if(clash AND kind <> 'gap' AND (l IS NULL OR r IS NULL)) AS n_edit_delete,
         count_if(clash AND kind = 'gap') AS n_insert_insert, {kept},
         sort_array(collect_list(CASE WHEN kind <> 'column' AND coalesce(m, v) IS NOT NULL
                                      THEN named_struct('pos', pos, 'm', m, 'was', CASE WHEN NOT m <=> v THEN v END, 'line', kind = 'line') END)) AS pieces
  FROM merged GROUP BY rid, id, drop_l, drop_r),
judged AS (SELECT *, drop_l AND NOT drop_r AND any_r OR drop_r AND NOT drop_l AND any_l AS conflict,
                  (drop_l OR drop_r) AND NOT (drop_l AND NOT drop_r AND any_r OR drop_r AND NOT drop_l AND any_l) AS gone FROM regrouped)
SELECT id, {shown},
       CASE WHEN conflict THEN array_join(transform(filter(pieces, p -> p.line), p -> coalesce(p.was, p.m)), '\\n')
            WHEN NOT gone THEN array_join(transform(filter(pieces, p -> p.m IS NOT NULL), p -> p.m), '\\n') END AS text, {alone}
FROM judged"""


def _added(n: int, branches: tuple[str, str], modulus: int) -> str:
    """SQL: the rows that branches add, merged by key and value."""
    left, right = branches
    cells = ", ".join(f"c{i}" for i in range(n))
    blank = ", ".join("NULL" for _ in range(n))
    kept = ", ".join(f"CASE WHEN NOT v.clash THEN a.c{i} END AS c{i}" for i in range(n))
    return f"""
WITH coded AS (SELECT {cells}, explode(array(named_struct('l', true, 'id', try_subtract(-1L, id), 'code', {_code(left, "'row'", modulus)}),
                                             named_struct('l', false, 'id', try_subtract(-2L, id), 'code', {_code(right, "'row'", modulus)}))) AS x FROM {{docs}}),
new AS (SELECT x.id, CASE x.code WHEN 3 THEN '!' ELSE '?' END AS text, {cells}, x.l AS l, NOT x.l AS r, false AS held FROM coded WHERE x.code IN (3, 4) AND x.id IS NOT NULL
        UNION ALL SELECT id, NULL, {blank}, NULL, NULL, true FROM {{docs}} WHERE id < 0),
added AS (SELECT id, text, {cells}, bool_or(l) AS l, bool_or(r) AS r, bool_or(held) AS held FROM new GROUP BY id, text, {cells}),
verdict AS (SELECT id, bool_or(l) AND bool_or(r) AND NOT bool_and(l AND r) AS clash, min(named_struct('text', text, 'c', array({cells}))) AS least
            FROM added GROUP BY id HAVING NOT bool_or(held))
SELECT /*+ MERGE(v) */ a.id, {kept}, CASE WHEN NOT v.clash THEN a.text END AS text, CAST(NOT v.clash AS LONG) AS n_clean, 0L AS n_edit_edit, 0L AS n_edit_delete, CAST(v.clash AS LONG) AS n_insert_insert
FROM added a JOIN verdict v ON a.id = v.id WHERE NOT v.clash OR v.least = named_struct('text', a.text, 'c', array({cells}))"""


def merge(spark: SparkSession, docs: DataFrame, *, branches: tuple[str, str] = ("L", "R"), key: str = "doc_id", text: str = "text", columns: tuple[str, ...] = ("lang", "source"), modulus: int = MODULUS) -> DataFrame:
    """key, columns, text (all but the key null where the row is gone), n_clean, n_edit_edit, n_edit_delete, n_insert_insert for every key ever present."""
    slim = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"c{i}") for i, c in enumerate(columns)))
    n = len(columns)
    out = spark.sql(_rows(n, branches, columns, modulus), docs=slim).unionByName(spark.sql(_added(n, branches, modulus), docs=slim))
    return out.select(F.col("id").alias(key), *(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)), F.col("text").alias(text), "n_clean", "n_edit_edit", "n_edit_delete", "n_insert_insert")
