"""The queries of :mod:`checks.queries` once more, in SQL for DuckDB.

Written from the definitions, not from the Spark plans: plain joins and sums, string
aggregation, window functions, and for generated data the published xxHash64 steps.
"""

from __future__ import annotations

import math
import re

from checks.queries import POWER_STEPS, SEGMENT
from cellwise.functions.mixing import ROUNDS
from cellwise.sources.generate import SEED

ORDER_PART = "select l_orderkey i, l_partkey j, sum(l_quantity) v from lineitem group by 1, 2 having sum(l_quantity) <> 0"
PART_SUPPLIER = "select l_partkey i, l_suppkey j, sum(l_quantity) v from lineitem group by 1, 2 having sum(l_quantity) <> 0"
SIZES = "select p_partkey k, cast(p_size as double) x from part"
BRANDED = "select p_partkey k, cast(p_size as double) x from part where p_brand = 'Brand#2'"
BALANCES = "select s_suppkey k, floor(s_acctbal) x from supplier"
MIXED_LINES = """select p_partkey as row, concat_ws(',', cast(p_size as varchar), cast(p_partkey % 3 as varchar),
  case when p_partkey % 7 = 0 then p_brand when p_partkey % 5 = 0 then ''
       else cast(cast(floor(p_retailprice) as int) as varchar) end, '0') as value from part"""
NUMBER_LINES = """select p_partkey as row, concat_ws(',', cast(p_size as varchar), cast(p_partkey % 3 as varchar), '0',
  cast(p_partkey % 4 as varchar)) as value from part"""


def matrix_vector(matrix: str, vector: str, rows: str, key: str, digits: int | None = None) -> str:
    """y for every key of the rows table, zero where nothing meets."""
    y = "coalesce(y, 0.0)" if digits is None else f"round(coalesce(y, 0.0), {digits})"
    return f"""with m as ({matrix}), x as ({vector}),
      q as (select m.i, sum(m.v * x.x) y from m join x on m.j = x.k group by m.i)
      select r.{key} as k, {y} as x from {rows} r left join q on r.{key} = q.i"""


# A byte at a time: eight shifts, with the polynomial where a one falls out.
CRC32_BYTE = """list_reduce(list_prepend(xor(acc, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
  lambda r, z: case when r & 1 = 1 then xor(r >> 1, 3988292384::bigint) else r >> 1 end)"""


def checksum_of(text: str) -> str:
    """CRC-32 of the ASCII text that the subquery gives as column t."""
    return f"""select lower(lpad(to_hex(xor(list_reduce(list_prepend(4294967295::bigint,
        list_transform(string_split(t, ''), lambda c: ascii(c)::bigint)), lambda acc, b: {CRC32_BYTE}), 4294967295::bigint)), 8, '0')) as crc32
      from ({text})"""


def power_steps(steps: int, residual: bool = False, history: bool = False) -> str:
    ctes = """e as (select s.l_partkey f, t.l_partkey t, count(*) w from lineitem s
        join lineitem t on s.l_orderkey = t.l_orderkey and t.l_linenumber = s.l_linenumber + 1 group by 1, 2),
      m as (select t i, e.f j, w / o.out v from e join (select f, sum(w) out from e group by f) o on e.f = o.f),
      n as (select cast(count(*) as double) n from part),
      x0 as (select p_partkey k, 1.0 / n x from part, n)"""
    for s in range(1, steps + 1):
        ctes += f""",
      y{s} as (select p.p_partkey k, coalesce(q.y, 0.0) y from part p
        left join (select m.i, sum(m.v * v.x) y from m join x{s - 1} v on m.j = v.k group by m.i) q on p.p_partkey = q.i),
      s{s} as (select case when sum(abs(y)) = 0 then 1.0 else sum(abs(y)) end s from y{s}),
      x{s} as (select k, 0.85 * y / s.s + (1 - 0.85) / n.n x from y{s}, s{s} s, n)"""
    if history:
        rounds = [
            f"""select {s} as step, round((select s from s{s}), 9) as norm, round(sum(abs(a.x - b.x)), 9) as residual
              from x{s} a join x{s - 1} b on a.k = b.k"""
            for s in range(1, steps + 1)
        ]
        return f"with {ctes.replace(' as (select', ' as materialized (select')} {' union all '.join(rounds)}"
    if residual:
        return f"""with {ctes} select {steps} as steps, round(sum(abs(a.x - b.x)), 9) as residual
          from x{steps} a join x{steps - 1} b on a.k = b.k"""
    return f"with {ctes} select k, round(x, 9) as x from x{steps}"


def exact_sum(x: str, scale: int) -> str:
    """Sum of doubles that are whole multiples of 2^-scale: added as HUGEINT, then rounded once.

    Sixty leading bits and one that says whether anything is below them; the cast to a double rounds these.
    """
    total = f"sum(({x} * pow(2.0::double, {scale}))::hugeint)"
    low = f"pow(2.0::double, greatest(0, floor(log2(abs({total})::double)) - 60))"
    lead = f"((abs({total}) // {low}::hugeint)::bigint | case when abs({total}) % {low}::hugeint <> 0 then 1 else 0 end)"
    return f"""case when {total} = 0 then 0.0::double
      else sign({total}) * {lead}::double * {low} * pow(2.0::double, {-scale}) end"""


def total_table() -> str:
    """The summary of events as timings; counts of events stand for run metrics."""
    timed, counted = [], []
    for engine, e, rest in (("RDD", "rdd", "event_id % 2 = 0"), ("DF", "df", "event_id % 2 <> 0")):
        where = f"filter (where {rest})"
        timed += [f'median(value) {where} as "{engine}_ms"', f'min(value) {where} as "{engine}_ms_min"',
                  f'max(value) {where} as "{engine}_ms_max"', f'round(stddev_pop(value) {where}, 6) as "{engine}_ms_std"']
        metrics = ["jobs", "stages", "tasks", "shuffle_read_bytes", "shuffle_write_bytes", "input_bytes", "output_bytes",
                   "mem_spill_bytes", "disk_spill_bytes", "gc_ms", "p50_ms", "p90_ms", "p99_ms", "max_ms"]
        counted += [f"count(*) filter (where {rest} and event_id % {p + 2} = 0) as {e}_{m}" for p, m in enumerate(metrics)]
        counted += [f"cast(max(event_id) {where} as varchar) as {e}_hash"]
    return f"""with c as (select event_type as name, max(event_id) as "A_rows", max(user_id) as "A_cols", max(user_id) as "B_rows",
        1 as "B_cols", max(event_id) as cells, max(event_id) > 2000000 as preview_used from events group by 1),
      t as (select event_type as name, case when user_id % 2 = 0 then 'baseline' else 'df_shuffle_200' end as ablation,
        {", ".join(timed + counted)} from events group by 1, 2)
      select t.*, c.* exclude (name) from t join c on t.name = c.name"""


def text_rows(matrix: str, rows: str, row_key: str, cols: str, col_key: str, width: int, separator: str = ", ") -> str:
    """Dense text of a matrix whose row and column keys are the keys of two tables."""
    return f"""with m as ({matrix}),
      g as (select r.{row_key} i, c.{col_key} j, coalesce(m.v, 0.0) v from {rows} r cross join {cols} c
            left join m on m.i = r.{row_key} and m.j = c.{col_key})
      select i, j // {width} as seg, string_agg(cast(v as varchar), '{separator}' order by j) as line
      from g group by 1, 2"""


def nearest(column: str, share: float) -> str:
    return f"max(case when rn - 1 = floor((n - 1) * {share} + 0.5) then {column} end)"


# The multipliers of xxHash64 and its seed in Spark.
P1, P2, P3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
P4, P5, HASH_SEED = 9650029242287828579, 2870177450012600261, 42
MASK = (1 << 64) - 1


class HashedColumns:
    """Columns that compute hashes step by step.

    Each step is named and lands in a subquery one level above the steps it reads, so
    that no step is ever written out twice.
    """

    def __init__(self):
        self.levels: list[list[str]] = []
        self.level_of: dict[str, int] = {}
        self.known: dict[tuple, str] = {}

    def name(self, expression: str) -> str:
        alias = f"t{len(self.level_of)}"
        level = max((self.level_of[t] + 1 for t in re.findall(r"\bt\d+\b", expression)), default=0)
        self.level_of[alias] = level
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(f"{expression} as {alias}")
        return alias

    @staticmethod
    def times(a: str, factor: int) -> str:
        return f"((({a}) * {factor}::uhugeint) & {MASK}::uhugeint)"

    def rotated(self, a: str, bits: int) -> str:
        return f"({self.times(a, 1 << bits)} | ({a} >> {64 - bits}))"

    def hashed(self, *keys: str | int) -> str:
        """Alias of the unsigned 64-bit hash of nonnegative numbers (or unsigned hashes)."""
        if keys in self.known:
            return self.known[keys]
        seed = f"{HASH_SEED}::uhugeint" if len(keys) == 1 else self.hashed(*keys[:-1])
        k = self.name(self.times(f"({keys[-1]})::uhugeint", P2))
        h = self.name(f"xor((({seed}) + {P5 + 8}::uhugeint) & {MASK}::uhugeint, {self.times(self.rotated(k, 31), P1)})")
        h = self.name(f"({self.times(self.rotated(h, 27), P1)} + {P4}::uhugeint) & {MASK}::uhugeint")
        h = self.name(self.times(f"xor({h}, {h} >> 33)", P2))
        h = self.name(self.times(f"xor({h}, {h} >> 29)", P3))
        h = self.name(f"xor({h}, {h} >> 32)")
        self.known[keys] = h
        return h

    def modulo(self, h: str, n: str) -> str:
        """The hash read as a signed number, modulo n, nonnegative."""
        signed = f"({h}::hugeint - case when {h} >= {1 << 63}::uhugeint then {1 << 64}::hugeint else 0::hugeint end)"
        return self.name(f"((({signed} % {n}) + {n}) % {n})::bigint")

    def uniform(self, *keys: str | int) -> str:
        return self.name(f"({self.hashed(*keys)} >> 11)::double * pow(2.0::double, -53)")

    def gaussian(self, *keys: str | int) -> str:
        one, two = self.uniform(*keys, 1), self.uniform(*keys, 2)
        return self.name(f"sqrt(-2.0 * ln(1.0::double - {one})) * cos({2 * math.pi!r}::double * {two})")

    def permuted(self, slot: str, row: str | int, seed: int, n: str) -> str:
        at = self.name(f"({slot} + {self.modulo(self.hashed(row, seed, 0), n)}) % {n}")
        for r in range(1, ROUNDS + 1):
            key = self.hashed(row, seed, r)
            partner = self.name(f"(({self.modulo(key, n)} - {at}) % {n} + {n}) % {n}")
            bit = self.hashed(f"greatest({at}, {partner})", key)
            at = self.name(f"case when ({bit} & 1::uhugeint) = 1 then {partner} else {at} end")
        return at

    def select(self, columns: str, source: str) -> str:
        for level in self.levels:
            source = f"(select *, {', '.join(level)} from {source})"
        return f"select {columns} from {source}"


def generated_cells(positions: str) -> str:
    """(i, j, v) with hashed values for (i, j) positions."""
    h = HashedColumns()
    value = h.gaussian("i", "j", SEED)
    return f"select i, j, v from ({h.select(f'i, j, round({value} * 10.0, 2) as v', f'({positions})')}) where v <> 0"


def filled_rows(degrees: str) -> str:
    """Cells for rows of (i, degree): distinct columns out of as many as suppliers."""
    h = HashedColumns()
    place = h.permuted("slot", "i", SEED, "n")
    slots = f"""(select i, unnest(range(degree)) slot, (select count(*) from supplier) n from ({degrees}) where degree > 0)"""
    return generated_cells(h.select(f"i, {place} as j", slots))


def generated_vector(positions: str) -> str:
    h = HashedColumns()
    value = h.gaussian("k", SEED)
    return h.select(f"k, round({value} * 10.0, 2) as x", f"({positions})")


def block_diagonal() -> str:
    h = HashedColumns()
    kept = h.uniform("i", "j", SEED, 0)
    cells = f"""(select i, unnest(range(i // 10 * 10, i // 10 * 10 + 10)) j
      from (select p_partkey i, (select count(*) from part) n from part) where i // 10 < n // 10)"""
    return generated_cells(f"select i, j from ({h.select(f'i, j, {kept} as u', cells)}) where u < 0.5")


def uniform_draws() -> str:
    h = HashedColumns()
    row = h.modulo(h.hashed("id", SEED, 1), "rows")
    col = h.modulo(h.hashed("id", SEED, 2), "cols")
    draws = """(select unnest(range(cast(floor(rows * cols * 0.05) as bigint))) id, rows, cols from
      (select (select count(*) from part) rows, (select count(*) from supplier) cols))"""
    return generated_cells(f"select distinct i, j from ({h.select(f'{row} as i, {col} as j', draws)})")


def power_law() -> str:
    h = HashedColumns()
    first, later = h.uniform("i", SEED, 11), h.uniform("i", SEED, 12)
    rows = "(select p_partkey i, (select count(*) from supplier) cols from part)"
    waits = h.select(f"i, cols, {later} as later, asinh(10.0::double) + ln(1.0::double - {first}) as left_over", rows)
    degrees = f"""select i, least(cols, case when left_over <= 0 then 0
        when exp(-left_over) >= 1 then 1
        else cast(floor(ln(1.0::double - later) / ln(1.0::double - exp(-left_over))) as bigint) + 1 end) degree
      from ({waits})"""
    return filled_rows(degrees)


def row_hotspot() -> str:
    h = HashedColumns()
    rank = h.permuted("i", 0, SEED + 1, "n")
    rows = "(select p_partkey i, (select count(*) from part) n from part)"
    degrees = f"""select i, cast(floor(s.c * case when rank < 10 then 0.5 else 0.01 end) as bigint) degree
      from ({h.select(f'i, {rank} as rank', rows)}), (select count(*) c from supplier) s"""
    return filled_rows(degrees)


def sparse_vector() -> str:
    h = HashedColumns()
    place = h.permuted("slot", 0, SEED, "n")
    slots = """(select unnest(range(greatest(1, cast(floor(n * 0.1) as bigint)))) slot, n
      from (select count(*) n from supplier))"""
    return f"select k, x from ({generated_vector(h.select(f'{place} as k', slots))}) where x <> 0"


def oracle_sql() -> dict[str, str]:
    transposed = "select l_suppkey i, l_partkey j, sum(l_quantity) v from lineitem group by 1, 2"
    uniform_rows = filled_rows(
        "select p_partkey i, greatest(1, cast(floor(s.c * 0.05) as bigint)) degree from part, (select count(*) c from supplier) s"
    )
    numbers = "list_filter(string_split(value, ','), lambda t: trim(t) <> '')"
    line_text = text_rows(PART_SUPPLIER, "(select * from part where p_partkey < {n})", "p_partkey", "supplier", "s_suppkey", 4096)
    grid_cells = f"""select row as i, cast(j - 1 as bigint) as j, cast(t as double) as v from
      (select row, unnest(string_split(value, ',')) t, unnest(range(1, len(string_split(value, ',')) + 1)) j from ({NUMBER_LINES}))"""
    product = f"""with a as ({transposed}), b as ({PART_SUPPLIER})
      select a.i, b.j, sum(a.v * b.v) v from a join b on a.j = b.i group by 1, 2"""
    sql = {
        "spmv": matrix_vector(ORDER_PART, SIZES, "orders", "o_orderkey"),
        "spmspv": matrix_vector(ORDER_PART, BRANDED, "orders", "o_orderkey"),
        "multiply_dispatch": matrix_vector(ORDER_PART, BRANDED, "orders", "o_orderkey"),
        "kernel_only": f"""with m as ({ORDER_PART}), x as ({BRANDED})
          select m.i as k, sum(m.v * x.x) as x from m join x on m.j = x.k group by 1""",
        "spmm": f"""with a as ({ORDER_PART}), b as ({PART_SUPPLIER})
          select a.i, b.j, sum(a.v * b.v) as v from a join b on a.j = b.i group by 1, 2""",
        "spdm": """with b as (select vec_id k, label, unnest(range(len(embedding))) j, cast(unnest(embedding) as double) b
            from embeddings)
          select cast(label as bigint) as i, cast(j as bigint) as j, round(sum(b), 6) as v from b group by 1, 2""",
        "multiply_to_text": text_rows(product, "supplier", "s_suppkey", "supplier", "s_suppkey", 4096),
        "multiply_files": """select c_custkey as k, cast(n_regionkey as double) as x
          from customer join nation on c_nationkey = n_nationkey""",
        "multiply_text_sparse": """select c_custkey as i, cast(n_regionkey as bigint) as j, cast(1 as double) as v
          from customer join nation on c_nationkey = n_nationkey""",
        "multiply_text_dense": """select c_custkey as i, cast(j as bigint) as j,
            cast(case when j = 0 then n_nationkey + 1 else n_regionkey + 1 end as double) as v
          from customer join nation on c_nationkey = n_nationkey cross join (select unnest([0, 1]) j)""",
        "multiply_text_row": """select c_custkey as k, cast(n_regionkey as double) as x
          from customer join nation on c_nationkey = n_nationkey""",
        "multiply_text_lenient_vector": """select p_partkey as k, cast(p_size + p_partkey % 3 * 4 as double) as x from part""",
        "multiply_text_lenient_matrix": """with a as (select p_partkey i, unnest([0, 2, 3]) k, unnest([p_size, p_partkey % 7, p_partkey % 3]) v from part),
          b as (select cast(r_regionkey as bigint) k, unnest([0, 2]) j, unnest([r_regionkey + 1, r_regionkey * 2]) v from region)
          select i, cast(j as bigint) as j, cast(sum(a.v * b.v) as double) as v from a join b on a.k = b.k and a.v <> 0 and b.v <> 0 group by 1, 2""",
        "spmv_repeated_keys": matrix_vector(
            transposed, "select l_partkey k, sum(l_quantity) x from lineitem group by 1", "supplier", "s_suppkey"
        ),
        "power_residual": power_steps(POWER_STEPS, residual=True),
        "power_iteration": power_steps(POWER_STEPS),
        "power_iteration_laid_out": power_steps(POWER_STEPS),
        "power_history": power_steps(POWER_STEPS, history=True),
        "spmv_exact": f"""with a as ({ORDER_PART}),
            q as (select a.i, {exact_sum("(a.v * p_retailprice)", 60)} as y from a join part on a.j = p_partkey group by 1)
          select o_orderkey as k, coalesce(y, 0.0) as x from orders left join q on o_orderkey = q.i""",
        "exact_totals": f"select event_type, {exact_sum('value', 70)} as total from events group by 1",
        "total_table": total_table(),
        "read_sparse_column": """select row_number() over (order by p_partkey) - 1 as k,
              case when p_partkey % 3 = 0 then 0 else p_retailprice end as x from part
            where p_partkey % 7 <> 3 qualify p_partkey % 3 <> 0""",
        "normalize_invisible": r"""select p_partkey, cast(0 as int) as pos,
            regexp_replace(trim(p_name || p_type || ' ' || p_brand || cast(p_size as varchar)), '\s+', ',', 'g') as value from part""",
        "l1_norm": f"select sum(abs(x)) as norm from ({SIZES})",
        "l1_distance": "select sum(abs(p_size - floor(p_retailprice))) as distance from part",
        "dense_rows": """with m as (select user_id % 7 i, event_id % 5 j, cast(count(*) as double) v from events
            group by 1, 2),
          g as (select r.range i, c.range j, coalesce(m.v, 0.0) v from range(8) r cross join range(6) c
            left join m on m.i = r.range and m.j = c.range)
          select i, cast(0 as bigint) as seg, string_agg(cast(v as varchar), ', ' order by j) as line from g group by 1""",
        "dense_segments": text_rows(transposed, "supplier", "s_suppkey", "part", "p_partkey", SEGMENT),
        "vector_line": f"""with y as ({matrix_vector(ORDER_PART, SIZES, "orders", "o_orderkey")})
          select k // {SEGMENT} as seg, string_agg(cast(x as varchar), ',' order by k) as line from y group by 1""",
        "checksum": checksum_of(f"""with y as ({matrix_vector(ORDER_PART, SIZES, "orders", "o_orderkey")})
          select string_agg(cast(x as varchar), ',' order by k) as t from y"""),
        "preview": line_text.format(n=100),
        "glance": f"""select i, case when length(line) > 120 then substring(line, 1, 120) || ' …' else line end as line
          from ({line_text.format(n=20)})""",
        "coo_from_table": ORDER_PART,
        "by_row": PART_SUPPLIER,
        "by_col": PART_SUPPLIER,
        "sparsity": """select count(*) filter (where l_tax <> 0) as nonzeros, count(l_tax) as total,
            count(*) filter (where l_tax <> 0) / count(l_tax) as rate,
            count(*) filter (where l_tax <> 0) / count(l_tax) < 0.5 as is_sparse from lineitem""",
        "line_sparsity": f"""with c as (select try_cast(unnest({numbers}) as double) v from ({MIXED_LINES})),
            n as (select count(*) filter (where v <> 0) as nonzeros, count(v) as total from c)
          select nonzeros, total, nonzeros / total as rate, nonzeros / total < 0.5 as is_sparse from n""",
        "matrix_sparsity": f"""with n as (select (select count(*) from ({ORDER_PART})) as nonzeros,
            (select count(*) from orders) * (select count(*) from part) as total)
          select nonzeros, total, nonzeros / total as rate, nonzeros / total < 0.5 as is_sparse from n""",
        "shape_profile": f"""with c as (select len({numbers}) tokens,
            len(list_filter({numbers}, lambda t: try_cast(t as double) is not null)) good, value from ({MIXED_LINES}))
          select count(*) as lines, count(*) filter (where trim(value) <> '') as filled_lines,
            min(tokens) filter (where trim(value) <> '') as min_tokens, count(*) filter (where good > 0) as numeric_lines,
            min(good) filter (where good > 0) as min_numbers, max(good) filter (where good > 0) as max_numbers from c""",
        "vector_class": """with f as (select greatest(1, count(*) // 40) files from part),
          c as (select p_partkey % files file, case when p_partkey % files % 4 = 0 then cast(p_size as varchar)
               when p_partkey % files % 4 = 1 then cast(p_size as varchar) || ',' || cast(p_partkey as varchar)
               when p_partkey % files % 4 = 2 and p_partkey >= files then null
               when p_partkey % files % 8 = 2 then cast(p_size as varchar) || ',7'
               when p_partkey % files % 4 = 2 then p_brand || ',7'
               when p_partkey >= files then p_brand else cast(p_size as varchar) end as value from part, f),
          s as (select file, count(value) as lines, max(len(string_split(value, ','))) widest,
               bool_and(len(list_filter(string_split(value, ','), lambda t: try_cast(t as double) is null)) = 0) ok
             from c where value is not null group by 1)
          select file, lines, case when lines = 1 and ok then 'row vector' when lines = 1 then 'single line with other text'
             when widest = 1 and ok then 'column vector' else 'neither' end as kind from s""",
        "vector_files": """with l as (select o_custkey % 40 f, count(*) n from orders where o_custkey % 4 < 3 group by 1)
          select cast(f as varchar) as file, n as lines, case when n = 1 and f % 4 < 2 then 'row vector' when n = 1 then 'single line with other text'
            when f % 4 = 0 then 'column vector' else 'neither' end as kind from l
          union all select 'none', 0, 'empty'""",
        "result_cells": """select p_partkey, p_partkey * 100 as a_rows, p_size - 1 as b_cols,
            p_partkey * 100 * greatest(p_size - 1, 1) as cells,
            p_partkey * 100 * greatest(p_size - 1, 1) > 2000000 as preview_used from part""",
        "numeric_lines": f"""select row, value from ({MIXED_LINES}) where len({numbers}) > 0
            and len(list_filter({numbers}, lambda t: try_cast(t as double) is null)) = 0""",
        "lenient_coo": f"""select row as i, cast(j - 1 as bigint) as j, v from
            (select row, try_cast(unnest({numbers}) as double) v, unnest(range(1, len({numbers}) + 1)) j from ({MIXED_LINES}))
          where v is not null and v <> 0""",
        "grid_to_coo": f"select i, j, v from ({grid_cells}) where v <> 0",
        "read_grid": f"select i, j, v from ({grid_cells}) where v <> 0",
        "read_dense": grid_cells,
        "read_lines": NUMBER_LINES,
        "normalize_text": r"""select p_partkey, cast(0 as int) as pos,
            regexp_replace(trim(p_name || '   ' || p_type), '\s+', ',', 'g') as value from part
          union all select p_partkey, 2, cast(p_size as varchar) || ',' || p_brand from part""",
        "read_column_vector": SIZES,
        "read_row_vector": f"select k, x from ({BALANCES}) where x <> 0",
        "nearest_rank": f"""with r as (select event_type, value, row_number() over (partition by event_type order by value) rn,
            count(*) over (partition by event_type) n from events where value is not null)
          select event_type, {nearest("value", 0.5)} as p50, {nearest("value", 0.9)} as p90,
            {nearest("value", 0.99)} as p99 from r group by 1""",
        "trial_stats": """select event_type, count(value) as trials, median(value) as median, min(value) as min,
            max(value) as max, round(stddev_pop(value), 6) as std from events group by 1""",
        "nearest_rank_null_keys": f"""with e as (select case when user_id % 10 <> 0 then event_type end as name, value from events),
          r as (select name, value, row_number() over (partition by name order by value) rn,
            count(*) over (partition by name) n from e where value is not null)
          select name, {nearest("value", 0.5)} as p50, {nearest("value", 0.9)} as p90 from r group by 1""",
        "trial_stats_null_keys": """select case when user_id % 10 <> 0 then event_type end as name, count(value) as trials,
            median(value) as median, min(value) as min, max(value) as max, round(stddev_pop(value), 6) as std
          from events group by 1""",
        "merge_summaries": """with e as (select event_type as name, event_id % 3 as trial, value,
            case when user_id % 2 = 0 then 'baseline' else 'df_no_broadcast+df_shuffle_200' end as ablation from events),
          t as (select name, ablation, max(value) as r, min(value) as d from e group by 1, 2),
          k as (select name, ablation, trial, max(value) as rk, min(value) as dk,
                  row_number() over (partition by name, ablation order by trial desc) as rn
                from e where name <> 'error' group by 1, 2, 3)
          select t.name, t.ablation, r as "RDD_ms", d as "DF_ms", rk as "RDD_kernel_ms", dk as "DF_kernel_ms",
            case when r <> 0 then round(d / r, 9) end as speedup_total,
            case when rk <> 0 then round(dk / rk, 9) end as speedup_kernel
          from t left join (select * from k where rn = 1) k on t.name = k.name and t.ablation = k.ablation""",
        "kernel_table": """with e as (select event_type as name, value,
            case when user_id % 2 = 0 then 'baseline' else 'df_shuffle_200' end as ablation, event_id % 2 = 0 as rdd from events)
          select name, ablation, median(value) filter (where rdd) as "RDD_kernel_ms",
            median(value) filter (where not rdd) as "DF_kernel_ms", min(value) filter (where rdd) as "RDD_kernel_min",
            max(value) filter (where rdd) as "RDD_kernel_max", min(value) filter (where not rdd) as "DF_kernel_min",
            max(value) filter (where not rdd) as "DF_kernel_max" from e group by 1, 2""",
        "event_log_rollup": f"""with e as (select event_type as label, event_id, user_id, cast(floor(value) as bigint) a,
            event_id % 10 > 1 as task from events),
          r as (select label, a, row_number() over (partition by label order by a) rn,
            count(*) over (partition by label) n from e where task and a is not null),
          p as (select label, {nearest("a", 0.5)} as p50_ms, {nearest("a", 0.9)} as p90_ms, {nearest("a", 0.99)} as p99_ms
            from r group by 1),
          s as (select label, count(*) filter (where event_id % 10 = 0) as jobs,
            count(*) filter (where event_id % 10 = 1) as stages, count(*) filter (where task) as tasks,
            cast(sum(a + user_id % 7) filter (where task) as bigint) as shuffle_read_bytes,
            cast(sum(user_id % 9) filter (where task) as bigint) as shuffle_write_bytes,
            cast(sum(a * 3) filter (where task) as bigint) as input_bytes,
            cast(sum(a * 2) filter (where task) as bigint) as output_bytes,
            cast(sum(event_id % 11) filter (where task) as bigint) as mem_spill_bytes,
            cast(sum(event_id % 13) filter (where task) as bigint) as disk_spill_bytes,
            cast(sum(event_id % 5) filter (where task) as bigint) as gc_ms,
            max(a) filter (where task) as max_ms from e group by 1)
          select s.label, jobs, stages, tasks, shuffle_read_bytes, shuffle_write_bytes, input_bytes, output_bytes,
            mem_spill_bytes, disk_spill_bytes, gc_ms, p50_ms, p90_ms, p99_ms, max_ms from s join p on s.label = p.label""",
        "event_log_runs": f"""with e as (select epoch_ms(ts) ms, event_id, cast(floor(value) as bigint) a, event_id % 10 = 0 job from events),
          m as (select cast(event_id as varchar) label, ms from e where event_id % 40 = 0),
          j as (select e.*, m.label from e asof join m on e.ms >= m.ms where e.ms <= m.ms + 3600000),
          r as (select label, a, row_number() over (partition by label order by a) rn, count(*) over (partition by label) n
            from j where not job and a is not null),
          p as (select label, {nearest("a", 0.5)} as p50_ms from r group by 1)
          select j.label, count(*) filter (where job) as jobs, count(*) filter (where not job) as tasks,
            cast(coalesce(sum(a * 3) filter (where not job), 0) as bigint) as input_bytes, cast(coalesce(sum(event_id % 5) filter (where not job), 0) as bigint) as gc_ms,
            coalesce(any_value(p50_ms), 0) as p50_ms, coalesce(max(a) filter (where not job), 0) as max_ms
          from j left join p on j.label = p.label group by 1""",
        "gen_power_law_exact": "select (select count(*) from part) as n_rows, (select count(*) from lineitem) as draws",
        "gen_identity": SIZES,
        "gen_diagonal": "select p_partkey as k, cast(p_size * (p_partkey % 5 + 1) as double) as x from part",
        "gen_zero": "select p_partkey as k, cast(0 as double) as x from part",
        "gen_upper": f"""with b as ({BALANCES}), n as (select count(*) n from supplier)
          select r.k, sum((r.k * n.n - r.k * (r.k + 1) // 2 + c.k + 1) * c.x) as x
          from b r join b c on c.k >= r.k cross join n group by 1""",
        "gen_banded": """select r.p_partkey as k, cast(sum((3 * r.p_partkey + c.p_partkey + 1) * c.p_size) as double) as x
          from (select p_partkey, unnest(range(p_partkey - 10, p_partkey + 11)) j from part) r
          join part c on c.p_partkey = r.j group by 1""",
        "gen_block_diagonal": matrix_vector(block_diagonal(), SIZES, "part", "p_partkey", 4),
        "gen_uniform_draws": matrix_vector(uniform_draws(), BALANCES, "part", "p_partkey", 4),
        "gen_uniform_rows": matrix_vector(uniform_rows, BALANCES, "part", "p_partkey", 4),
        "gen_power_law": matrix_vector(power_law(), BALANCES, "part", "p_partkey", 4),
        "gen_row_hotspot": matrix_vector(row_hotspot(), BALANCES, "part", "p_partkey", 4),
        "gen_dense_vector": matrix_vector(
            PART_SUPPLIER, generated_vector("select s_suppkey k from supplier"), "part", "p_partkey", 4
        ),
        "gen_sparse_vector": matrix_vector(PART_SUPPLIER, sparse_vector(), "part", "p_partkey", 4),
    }
    return sql
