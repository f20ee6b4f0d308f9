"""ANSI SQL that gives the same result as each registered query on the same tables."""

from rowloom.operators.grids import LAYOUTS

# Process grid of the layout queries: 2 x 3.
R, C, P = 2, 3, 6

E = """e AS (SELECT vec_id AS i, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS j,
       CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""
E_ALL = f"WITH {E} SELECT i, j, x FROM e"
E_M = "(SELECT max(vec_id) + 1 FROM embeddings)"
E_N = "(SELECT max(len(embedding)) FROM embeddings)"
O = """o AS (SELECT o_orderkey AS i, CAST(0 AS BIGINT) AS j, CAST(o_custkey AS DOUBLE) AS x FROM orders
       UNION ALL SELECT o_orderkey, CAST(1 AS BIGINT), o_totalprice FROM orders)"""
O_ALL = f"WITH {O} SELECT i, j, x FROM o"
LB = """lb AS (SELECT doc_id AS i, CAST(0 AS BIGINT) AS j, CAST(quality AS DOUBLE) AS x FROM labels
       UNION ALL SELECT doc_id, CAST(1 AS BIGINT), CAST(toxic AS DOUBLE) FROM labels)"""
EV = """names AS (SELECT list_sort(list(DISTINCT event_type)) AS all_types FROM events),
       ev AS (SELECT user_id AS i, CAST(list_position((SELECT all_types FROM names), event_type) - 1 AS BIGINT) AS j,
       CAST(count(*) AS DOUBLE) AS x FROM events GROUP BY user_id, event_type)"""
LP = """lp AS (SELECT l_orderkey AS i, l_partkey AS j, l_quantity AS x FROM lineitem)"""
LINES = """l AS (SELECT l_quantity / 50 AS c0, l_extendedprice / 100000 AS c1, l_discount AS c2, l_tax AS c3 FROM lineitem)"""
CENTROIDS = """w AS (SELECT j AS k, CAST(label AS BIGINT) AS j, avg(x) AS x FROM e JOIN embeddings ON e.i = vec_id
       GROUP BY 1, 2)"""


def rounded(x: str, places: int = 6) -> str:
    return f"CASE WHEN abs({x}) < 0.5e-{places} THEN CAST(0 AS DOUBLE) ELSE round({x}, {places}) END"


# Grid coordinates per layout; None stands for a copy on every value.
COORDINATES = {
    "MC_MR": (f"i % {R}", f"j % {C}"),
    "MC_STAR": (f"i % {R}", None),
    "MD_STAR": (f"i % {R}", f"i % {C}"),
    "MR_MC": (f"j % {R}", f"i % {C}"),
    "MR_STAR": (None, f"i % {C}"),
    "STAR_MC": (f"j % {R}", None),
    "STAR_MD": (f"j % {R}", f"j % {C}"),
    "STAR_MR": (None, f"j % {C}"),
    "STAR_STAR": (None, None),
    "STAR_VC": (f"(j % {P}) % {R}", f"(j % {P}) // {R}"),
    "STAR_VR": (f"(j % {P}) // {C}", f"(j % {P}) % {C}"),
    "VC_STAR": (f"(i % {P}) % {R}", f"(i % {P}) // {R}"),
    "VR_STAR": (f"(i % {P}) // {C}", f"(i % {P}) % {C}"),
    "CIRC_CIRC": ("0", "0"),
}
GRID = f"g AS (SELECT range % {R} AS a, range // {R} AS b, range AS worker FROM range({P}))"


def assigned(layout: str, source: str, columns: str = "i, j, x") -> str:
    """Cells of ``source`` joined to the grid positions that hold them."""
    a, b = COORDINATES[layout]
    match = " AND ".join(f"g.{n} = {c}" for n, c in (("a", a), ("b", b)) if c) or "true"
    return f"""SELECT {columns}, CAST(g.a AS INTEGER) AS a, CAST(g.b AS INTEGER) AS b,
       CAST(g.a + g.b * {R} AS INTEGER) AS owner FROM {source} JOIN g ON {match}"""


def volume(layout: str, ctes: str, source: str) -> str:
    return f"""WITH {ctes}, {GRID}, t AS ({assigned(layout, source, "i, j")}),
       s AS (SELECT owner, CAST(count(DISTINCT i) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS elements FROM t GROUP BY owner)
       SELECT *, CAST(8 * elements AS BIGINT) AS bytes FROM s"""


def _ranges() -> str:
    """Owned ranges of every layout, found by looking at which indices each worker holds."""
    parts = []
    for layout in LAYOUTS:
        a, b = COORDINATES[layout]
        by_row = " AND ".join(f"g.{n} = {c}" for n, c in (("a", a), ("b", b)) if c and "i" in c) or "true"
        by_col = " AND ".join(f"g.{n} = {c}" for n, c in (("a", a), ("b", b)) if c and "j" in c) or "true"
        if layout == "CIRC_CIRC":
            by_row = by_col = "g.worker = 0"
        row, col = layout.split("_")
        step = {"MC": R, "MR": C, "VC": P, "VR": P, "MD": 6}
        parts.append(
            f"""SELECT '{layout}' AS layout, CAST(worker AS INTEGER) AS worker, CAST(a AS INTEGER) AS a,
            CAST(b AS INTEGER) AS b, (SELECT min(i) FROM ii WHERE {by_row}) AS row_start,
            CAST({E_M} - 1 AS BIGINT) AS row_end, CAST({step.get(row, 1)} AS BIGINT) AS row_step,
            (SELECT min(j) FROM jj WHERE {by_col}) AS col_start, CAST({E_N} - 1 AS BIGINT) AS col_end,
            CAST({step.get(col, 1)} AS BIGINT) AS col_step,
            CAST((SELECT count(*) FROM ii WHERE {by_row}) * (SELECT count(*) FROM jj WHERE {by_col}) AS BIGINT) AS cells
            FROM g"""
        )
    return f"""WITH {GRID}, ii AS (SELECT range AS i FROM range(0, (SELECT max(vec_id) + 1 FROM embeddings))),
       jj AS (SELECT range AS j FROM range(0, (SELECT max(len(embedding)) FROM embeddings)))
       """ + " UNION ALL ".join(parts)


def tiles(source: str, rows: int, cols: int, m: str, n: str) -> str:
    return f"""SELECT i // {rows} AS bi, j // {cols} AS bj, i // {rows} * {rows} AS i0, j // {cols} * {cols} AS j0,
       CAST(least({rows}, {m} - i // {rows} * {rows}) AS INTEGER) AS nr,
       CAST(least({cols}, {n} - j // {cols} * {cols}) AS INTEGER) AS nc,
       CAST(i % {rows} * least({cols}, {n} - j // {cols} * {cols}) + j % {cols} AS INTEGER) AS p, x FROM {source}"""


def uniform(i: str, j: str, seed: int) -> tuple[str, str]:
    """The two words of the generator as nested subqueries over columns i, j."""
    mixed = lambda x, p: f"((({x}) * ({x})) % {p} + (({x}) * 48271) % {p} + 12345) % {p}"
    primes = (2147483647, 2147483629)
    columns = lambda f: ", ".join(f"CAST({f(k, p)} AS BIGINT) AS w{k}" for k, p in enumerate(primes))
    query = f"SELECT {i} AS i, {j} AS j, {columns(lambda k, p: f'{i} % {p}')} FROM c"
    query = f"SELECT i, j, {columns(lambda k, p: f'({mixed(f"w{k}", p)} + i // {p} + {seed}) % {p}')} FROM ({query})"
    query = f"SELECT i, j, {columns(lambda k, p: f'({mixed(f"w{k}", p)} + j) % {p}')} FROM ({query})"
    for _ in range(2):
        query = f"SELECT i, j, {columns(lambda k, p: mixed(f'w{k}', p))} FROM ({query})"
    return query, f"(w0 + w1 / CAST({primes[1]} AS DOUBLE)) / CAST({primes[0]} AS DOUBLE)"


def _random() -> str:
    query, value = uniform("i", "j", 1000)
    return f"""WITH c AS (SELECT c_custkey AS i, range AS j FROM customer, range(16))
       SELECT i, j, {value} AS x FROM ({query})"""


def two_columns(x: str, y: str, source: str) -> str:
    """Closed form of a two-column decomposition: values l1 >= l2 of the Gram matrix and unit vector (vx, vy)."""
    return f"""t AS (SELECT CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y, * FROM {source}),
       g AS (SELECT sum(x * x) AS a, sum(x * y) AS b, sum(y * y) AS d FROM t),
       h AS (SELECT *, (a + d + sqrt((a - d) * (a - d) + 4 * b * b)) / 2 AS l1 FROM g),
       l AS (SELECT *, (a * d - b * b) / l1 AS l2, b / sqrt(b * b + (l1 - a) * (l1 - a)) AS px,
             (l1 - a) / sqrt(b * b + (l1 - a) * (l1 - a)) AS py FROM h),
       q AS (SELECT *, CASE WHEN (CASE WHEN abs(px) >= abs(py) THEN px ELSE py END) < 0 THEN -1 ELSE 1 END AS s1,
             CASE WHEN (CASE WHEN abs(py) >= abs(px) THEN py ELSE -px END) < 0 THEN -1 ELSE 1 END AS s2 FROM l),
       v AS (SELECT sqrt(l1) AS sigma1, sqrt(l2) AS sigma2, px * s1 AS v1x, py * s1 AS v1y,
             py * s2 AS v2x, -px * s2 AS v2y, l1, l2 FROM q)"""


PARTS2 = two_columns("p_size", "floor(p_retailprice / 10)", "part")
SIGMA2 = "SELECT CAST(0 AS INTEGER) AS k, round(sigma1, 6) AS sigma FROM v UNION ALL SELECT CAST(1 AS INTEGER), round(sigma2, 6) FROM v"


def _u2() -> str:
    u = [f"(x * v{k}x + y * v{k}y) / sigma{k}" for k in (1, 2)]
    return f"""WITH {PARTS2} SELECT p_partkey AS i, CAST(0 AS BIGINT) AS j, {rounded(u[0])} AS x FROM t, v
       UNION ALL SELECT p_partkey, CAST(1 AS BIGINT), {rounded(u[1])} FROM t, v"""


def _v2() -> str:
    cells = [("0", "0", "v1x"), ("1", "0", "v1y"), ("0", "1", "v2x"), ("1", "1", "v2y")]
    return f"WITH {PARTS2} " + " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS i, CAST({j} AS BIGINT) AS j, {rounded(x)} AS x FROM v" for i, j, x in cells
    )


def _gram_lines() -> str:
    return f"WITH {LINES} " + " UNION ALL ".join(
        f"SELECT CAST({p} AS BIGINT) AS i, CAST({q} AS BIGINT) AS j, round(sum(c{p} * c{q}), 6) AS x FROM l"
        for p in range(4)
        for q in range(4)
    )


GRAM = f"WITH {E} SELECT a.j AS i, b.j AS j, {rounded('sum(a.x * b.x)')} AS x FROM e a JOIN e b ON a.i = b.i GROUP BY a.j, b.j"
IDENTITY = f"""SELECT CAST(a.range AS BIGINT) AS i, CAST(b.range AS BIGINT) AS j,
       CASE WHEN a.range = b.range THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS x
       FROM range(0, {E_N}) a, range(0, {E_N}) b"""
PROJECTED = f"WITH {E}, {CENTROIDS} SELECT e.i, w.j, {rounded('sum(e.x * w.x)')} AS x FROM e JOIN w ON e.j = w.k GROUP BY e.i, w.j"
REVERSED = f"FROM e a JOIN e b ON b.i = {E_M} - 1 - a.i AND a.j = b.j GROUP BY a.i"
NORMS = f"WITH {E} SELECT i, {rounded('sqrt(sum(x * x))')} AS norm FROM e GROUP BY i"
SQDIST = f"WITH {E} SELECT a.i, {rounded('sum((a.x - b.x) * (a.x - b.x))')} AS sqdist {REVERSED}"
DOT = f"WITH {E} SELECT a.i, {rounded('sum(a.x * b.x)')} AS dot {REVERSED}"
ENERGY = f"WITH {E} SELECT round(sum(x * x), 6) AS frobenius_sq FROM e"
FILLED = f"""WITH {LB}, s AS (SELECT r.range AS i, c.range AS j FROM range(0, (SELECT max(doc_id) + 1 FROM documents)) r, range(2) c)
       SELECT s.i, s.j, coalesce(lb.x, CAST(0 AS DOUBLE)) AS x FROM s LEFT JOIN lb ON s.i = lb.i AND s.j = lb.j"""


LP_SUMS = f"{LP}, ls AS (SELECT i, j, sum(x) AS x FROM lp GROUP BY i, j)"
NATIONS = """no AS (SELECT CAST(c_nationkey AS BIGINT) AS i, o_orderkey AS j, o_totalprice AS x FROM orders
       JOIN customer ON o_custkey = c_custkey),
       ns AS (SELECT i, sqrt(sum(x * x)) AS sigma, row_number() OVER (ORDER BY sum(x * x) DESC) - 1 AS k FROM no GROUP BY i),
       nt AS (SELECT * FROM ns WHERE k < 5)"""

# Each brand's pair of columns has one large and one small singular value; the five largest are five brands' large ones.
BRANDS = """bt AS (SELECT p_partkey AS i, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) - 1 AS brand,
       CAST(p_size AS DOUBLE) AS x, CAST(floor(p_retailprice / 10) AS DOUBLE) AS y FROM part),
       bg AS (SELECT brand, sum(x * x) AS a, sum(x * y) AS b, sum(y * y) AS d FROM bt GROUP BY brand),
       bl AS (SELECT *, (a + d + sqrt((a - d) * (a - d) + 4 * b * b)) / 2 AS l FROM bg),
       bk AS (SELECT brand, sqrt(l) AS sigma, l, b / sqrt(b * b + (l - a) * (l - a)) AS vx,
              (l - a) / sqrt(b * b + (l - a) * (l - a)) AS vy, row_number() OVER (ORDER BY l DESC) - 1 AS k FROM bl),
       top AS (SELECT * FROM bk WHERE k < 5),
       be AS (SELECT (SELECT sum(a + d) FROM bg) AS norm, (SELECT sum(l) FROM top) AS held)"""
SIGMA_BRANDS = f"WITH {BRANDS} SELECT CAST(k AS INTEGER) AS k, round(sigma, 6) AS sigma FROM top"
V_BRANDS = f"""WITH {BRANDS} SELECT 2 * r.range + c.range AS i, CAST(q.range AS BIGINT) AS j,
       {rounded("coalesce(CASE WHEN c.range = 0 THEN vx ELSE vy END, CAST(0 AS DOUBLE))")} AS x
       FROM range(25) r, range(2) c, range(5) q LEFT JOIN top ON brand = r.range AND k = q.range"""


def all_oracles() -> dict[str, str]:
    """SQL by query name; queries without an entry have no SQL form (general SVD, run-dependent profile)."""
    found = {
        "read_libsvm_matrix": E_ALL,
        "random_matrix": _random(),
        "row_spine": "SELECT range AS i FROM range(0, (SELECT max(o_orderkey) + 1 FROM orders))",
        "append_rows": O_ALL,
        "put_get_blocks": E_ALL,
        "parse_vectors": E_ALL,
        "parse_vectors_sparse": f"WITH {LB} SELECT i, j, x FROM lb",
        "matrix_info": f"""WITH {E} SELECT 'embeddings' AS name, CAST({E_M} AS BIGINT) AS num_rows,
            CAST({E_N} AS BIGINT) AS num_cols, (SELECT count(*) FROM embeddings) AS stored_rows,
            CAST(sum(CASE WHEN x <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS nnz,
            CAST(sum(CASE WHEN x <> 0 THEN 1 ELSE 0 END) AS DOUBLE) / ({E_M} * {E_N}) AS density,
            'VC_STAR' AS layout, CAST(11 AS INTEGER) AS layout_code, 'VC/STAR' AS layout_label, CAST({R} AS INTEGER) AS grid_rows,
            CAST({C} AS INTEGER) AS grid_cols, CAST({P} AS INTEGER) AS num_partitions FROM e""",
        "matrix_info_cells": f"""WITH {LB}, k AS (SELECT * FROM lb WHERE x <> 0),
            d AS (SELECT max(i) + 1 AS m, max(j) + 1 AS n, count(*) AS c FROM k)
            SELECT 'labels' AS name, m AS num_rows, n AS num_cols, c AS nnz, CAST(c AS DOUBLE) / (m * n) AS density,
            'MC_MR' AS layout, CAST(0 AS INTEGER) AS layout_code, 'MC/MR' AS layout_label, CAST({R} AS INTEGER) AS grid_rows,
            CAST({C} AS INTEGER) AS grid_cols, CAST({P} AS INTEGER) AS num_partitions FROM d""",
        "describe_matrix": f"""WITH {O} SELECT 'orders' AS name, format('orders: {{}} x {{}}, {{}} nonzero, layout VR/STAR, grid {R} x {C}',
            max(i) + 1, max(j) + 1, count(*) FILTER (WHERE x <> 0)) AS description FROM o""",
        "register_matrix": """SELECT s_suppkey AS i, CAST(0 AS BIGINT) AS j, CAST(s_nationkey AS DOUBLE) AS x FROM supplier
            UNION ALL SELECT s_suppkey, CAST(1 AS BIGINT), s_acctbal FROM supplier""",
        "matrix_density": f"""WITH {EV} SELECT max(i) + 1 AS num_rows, max(j) + 1 AS num_cols, count(*) AS nnz,
            CAST(count(*) AS DOUBLE) / ((max(i) + 1) * (max(j) + 1)) AS density FROM ev""",
        "matrix_density_rows": f"""WITH {LB} SELECT max(i) + 1 AS num_rows, max(j) + 1 AS num_cols,
            count(*) FILTER (WHERE x <> 0) AS nnz,
            round(CAST(count(*) FILTER (WHERE x <> 0) AS DOUBLE) / ((max(i) + 1) * 2), 9) AS density FROM lb""",
        "zero_fill": FILLED,
        "densify": FILLED,
        "rows_to_coo": E_ALL,
        "coo_to_rows": E_ALL,
        "coo_from_events": f"""WITH {EV}, s AS (SELECT DISTINCT i, range AS j FROM ev, range(0, (SELECT max(j) + 1 FROM ev)))
            SELECT s.i, s.j, coalesce(ev.x, CAST(0 AS DOUBLE)) AS x FROM s LEFT JOIN ev ON s.i = ev.i AND s.j = ev.j""",
        "coo_repeated_cells": """WITH k AS (SELECT o_custkey AS i, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS j FROM orders),
            s AS (SELECT DISTINCT i, range AS j FROM k, range(3))
            SELECT s.i, s.j, CAST(count(k.i) AS DOUBLE) AS x FROM s LEFT JOIN k ON s.i = k.i AND s.j = k.j GROUP BY s.i, s.j""",
        "to_blocks": f"WITH {E} {tiles('e', 48, 20, E_M, E_N)}",
        "to_blocks_gaps": f"""WITH {LB}, t AS (SELECT DISTINCT i // 16 AS t FROM lb),
            s AS (SELECT t * 16 + r.range AS i, c.range AS j FROM t, range(16) r, range(2) c
                  WHERE t * 16 + r.range <= (SELECT max(doc_id) FROM labels))
            SELECT s.i, s.j, coalesce(lb.x, CAST(0 AS DOUBLE)) AS x FROM s LEFT JOIN lb ON s.i = lb.i AND s.j = lb.j""",
        "cells_to_blocks": f"""WITH {EV}, s AS (SELECT r.range AS i, c.range AS j FROM range(0, (SELECT max(i) + 1 FROM ev)) r,
            range(0, (SELECT max(j) + 1 FROM ev)) c), t AS (SELECT DISTINCT i // 32 AS bi, j // 3 AS bj FROM ev),
            f AS (SELECT s.i, s.j, coalesce(ev.x, CAST(0 AS DOUBLE)) AS x FROM s JOIN t ON s.i // 32 = bi AND s.j // 3 = bj
                  LEFT JOIN ev ON s.i = ev.i AND s.j = ev.j)
            {tiles('f', 32, 3, '(SELECT max(i) + 1 FROM ev)', '(SELECT max(j) + 1 FROM ev)')}""",
        "blocks_roundtrip": E_ALL,
        "transpose": f"WITH {EV} SELECT j AS i, i AS j, x FROM ev",
        "transpose_blocks": f"WITH {E} SELECT j AS i, i AS j, x FROM e",
        "transpose_rows": f"WITH {E} SELECT j AS i, i AS j, x FROM e",
        "select_rows": """WITH k AS (SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders))
            SELECT c_custkey AS i, CAST(0 AS BIGINT) AS j, CAST(c_nationkey AS DOUBLE) AS x FROM k
            UNION ALL SELECT c_custkey, CAST(1 AS BIGINT), c_acctbal FROM k""",
        "row_indices": "SELECT o_orderkey AS i FROM orders",
        "block_slice": f"""WITH {E} SELECT i, (j - 2) // 5 AS j, x FROM e WHERE i >= 1 AND (i - 1) % 3 = 0
            AND j BETWEEN 2 AND 61 AND (j - 2) % 5 = 0""",
        "block_slice_cells": f"WITH {LP} SELECT i, j, x FROM lp WHERE i % 2 = 0 AND j >= 1 AND (j - 1) % 3 = 0",
        "block_slice_blocks": f"""WITH {E} SELECT i, j, x FROM e WHERE i BETWEEN 10 AND {E_M} - 10 AND (i - 10) % 7 = 0
            AND j BETWEEN 5 AND 60 AND (j - 5) % 4 = 0""",
        "union_rows": """SELECT c_custkey AS i, CAST(0 AS INTEGER) AS j, CAST(c_nationkey AS DOUBLE) AS x FROM customer
            UNION ALL SELECT c_custkey, CAST(1 AS INTEGER), c_acctbal FROM customer
            UNION ALL SELECT s_suppkey, CAST(0 AS INTEGER), CAST(s_nationkey AS DOUBLE) FROM supplier
            UNION ALL SELECT s_suppkey, CAST(1 AS INTEGER), s_acctbal FROM supplier""",
        "common_rows": "SELECT o_custkey AS i FROM orders INTERSECT ALL SELECT user_id FROM events",
        "layout_ranges": _ranges(),
        "layout_volume_orders": volume("VC_STAR", O, "o"),
        "layout_volume_cells": volume("MC_MR", EV, "ev"),
        "grid_table": f"""WITH {GRID}, o AS (SELECT o_orderkey AS i, 0 AS j FROM orders), t AS ({assigned("VR_STAR", "o", "i")})
            SELECT owner AS worker, a, b, count(*) AS records FROM t GROUP BY owner, a, b""",
        "frobenius_sq": ENERGY,
        "frobenius_sq_lines": f"WITH {LINES} SELECT round(sum(c0 * c0 + c1 * c1 + c2 * c2 + c3 * c3), 4) AS frobenius_sq FROM l",
        "row_norms": NORMS,
        "row_sqdist": SQDIST,
        "row_dots": DOT,
        "gramian": GRAM,
        "gramian_lines": _gram_lines(),
        "project_rows": PROJECTED,
        "matmul": f"""WITH {LP}, p AS (SELECT p_partkey AS k, CAST(0 AS BIGINT) AS j, CAST(p_size AS DOUBLE) AS x FROM part
            UNION ALL SELECT p_partkey, CAST(1 AS BIGINT), floor(p_retailprice / 10) FROM part)
            SELECT lp.i, p.j, sum(lp.x * p.x) AS x FROM lp JOIN p ON lp.j = p.k GROUP BY lp.i, p.j""",
        "matmul_rows": PROJECTED,
        "matmul_blocks": PROJECTED,
        "matrix_diff": """WITH k AS (SELECT c_custkey AS i, CAST(0 AS BIGINT) AS j, CAST(c_nationkey AS DOUBLE) AS xa FROM customer
            UNION ALL SELECT c_custkey, CAST(1 AS BIGINT), c_acctbal FROM customer)
            SELECT i, j, xa, floor(xa) AS xb FROM k WHERE abs(xa - floor(xa)) > 0.25""",
        "matrix_diff_absent": f"""WITH {LB} SELECT i, j, x AS xa, CAST(0 AS DOUBLE) AS xb FROM lb
            WHERE x <> 0 AND i NOT IN (SELECT doc_id FROM labels WHERE toxic > 0)""",
        "matrix_diff_cells": f"WITH {LB} SELECT i, j, x AS xa, 2 * x AS xb FROM lb WHERE x <> 0",
        "matrix_diff_stored": f"WITH {E} SELECT i, j, x AS xa, x AS xb FROM e WHERE false",
        "svd_s_2col": f"WITH {PARTS2} {SIGMA2}",
        "svd_s_2col_tsqr": f"WITH {PARTS2} {SIGMA2}",
        "svd_s_2col_krylov": f"WITH {PARTS2} {SIGMA2}",
        "svd_s_lines": f"WITH {two_columns('l_quantity', 'round(l_discount * 100)', 'lineitem')} {SIGMA2}",
        "svd_v_2col": _v2(),
        "svd_u_2col": _u2(),
        "relative_error_2col": f"WITH {PARTS2} SELECT round(l2 / (l1 + l2), 9) AS relative_error FROM v",
        "svd_full_reconstruct": f"WITH {E} SELECT i, j, {rounded('x')} AS x FROM e",
        "svd_gram_reconstruct": GRAM,
        "svd_orthonormal_u": IDENTITY,
        "svd_orthonormal_v": IDENTITY,
        "svd_energy": ENERGY,
        "svd_energy_tsqr": ENERGY,
        "svd_energy_krylov": ENERGY,
        "put_get_orders": O_ALL,
        "put_get_cells_mc_mr": f"WITH {EV} SELECT i, j, x FROM ev",
        "put_get_cells_star_vr": f"WITH {EV} SELECT i, j, x FROM ev",
        "put_get_tiles_mc_mr": E_ALL,
        "put_get_tiles_mr_star": E_ALL,
        "read_matrix_source": E_ALL,
        "read_matrix_source_orders": O_ALL,
        "read_matrix_source_pieces": E_ALL,
        "reopen_matrix": """SELECT c_custkey AS i, CAST(0 AS BIGINT) AS j, CAST(c_nationkey AS DOUBLE) AS x FROM customer
            UNION ALL SELECT c_custkey, CAST(1 AS BIGINT), c_acctbal FROM customer""",
        "compact_matrix": O_ALL,
        "redistribute_mc_mr_to_vr_star": E_ALL,
        "redistribute_vc_star_to_star_vr": E_ALL,
        "redistribute_mc_mr_to_mr_mc": E_ALL,
        "layout_moves": f"""WITH {E}, o AS (SELECT i, j, CAST(i % {R} + j % {C} * {R} AS INTEGER) AS source,
            CAST((i % 6) // 2 + (i % 6) % 2 * 3 AS INTEGER) AS target FROM e)
            SELECT source, target, min(i) AS row_start, CAST(6 AS BIGINT) AS row_step, min(j) AS col_start,
            CAST(3 AS BIGINT) AS col_step, count(*) AS cells, CAST(source <> target AS INTEGER) AS moves FROM o GROUP BY source, target""",
        "block_ranges_stored": f"""WITH {E}, r AS (SELECT o_orderkey AS request, o_orderkey % 400 AS rs, o_orderkey % 400 + o_custkey % 25 AS re,
            1 + o_orderkey % 3 AS rt, o_custkey % 50 AS cs, o_custkey % 50 + 9 AS ce, 1 + o_custkey % 4 AS ct FROM orders),
            a AS (SELECT request, unnest(range(rs, re + 1, rt)) AS i, cs, ce, ct FROM r),
            b AS (SELECT request, i, unnest(range(cs, ce + 1, ct)) AS j FROM a)
            SELECT request, i, j, x FROM b JOIN e USING (i, j)""",
        "matrix_diff_blocks": f"""WITH {LB} SELECT i, j, x AS xa, CAST(0 AS DOUBLE) AS xb FROM lb
            WHERE x <> 0 AND i NOT IN (SELECT doc_id FROM labels WHERE toxic > 0)""",
        "read_libsvm_sparse": f"WITH {LP_SUMS} SELECT i, j, x FROM ls",
        "sparse_rows": f"WITH {EV} SELECT i, j, x FROM ev",
        "sparse_rows_labels": f"WITH {LB} SELECT i, j, x FROM lb WHERE x <> 0",
        "gramian_sparse": f"""WITH {LP_SUMS} SELECT a.j AS i, b.j AS j, sum(a.x * b.x) AS x FROM ls a JOIN ls b ON a.i = b.i
            GROUP BY a.j, b.j""",
        "gramian_sparse_events": f"""WITH {EV} SELECT a.j AS i, b.j AS j, sum(a.x * b.x) AS x FROM ev a JOIN ev b ON a.i = b.i
            GROUP BY a.j, b.j""",
        "frobenius_sq_sparse": f"WITH {LP_SUMS} SELECT sum(x * x) AS frobenius_sq FROM ls",
        "block_slices": f"""WITH {E} SELECT i, j, x FROM e WHERE (i <= 40 AND i % 4 = 0 AND j <= 30 AND j % 3 = 0)
            OR (i BETWEEN 20 AND 90 AND i % 5 = 0 AND j BETWEEN 10 AND 63) OR (i = 7 AND j % 2 = 0)""",
        "route": f"""WITH {O}, {GRID}, t AS ({assigned("VC_STAR", "o")})
            SELECT owner AS partition, owner, count(*) AS records FROM t WHERE j = 0 GROUP BY owner""",
        "gramian_panels": GRAM,
        "gramian_panels_wide": """WITH c AS (SELECT user_id AS i, event_id % 4800 AS j, CAST(count(*) AS DOUBLE) AS x FROM events
            GROUP BY user_id, event_id % 4800),
            g AS (SELECT a.j AS i, b.j AS j, sum(a.x * b.x) AS x FROM c a JOIN c b ON a.i = b.i GROUP BY a.j, b.j),
            s AS (SELECT i, sum(CASE WHEN i = j THEN x ELSE 0 END) AS own, sum(x) AS total, sum(x * x) AS squares FROM g GROUP BY i)
            SELECT r.range AS i, coalesce(own, 0) AS own, coalesce(total, 0) AS total, coalesce(squares, 0) AS squares
            FROM range(4800) r LEFT JOIN s ON s.i = r.range""",
        "svd_s_wide": f"WITH {NATIONS} SELECT CAST(k AS INTEGER) AS k, round(sigma, 2) AS sigma FROM nt",
        "svd_v_wide": f"""WITH {NATIONS} SELECT r.range AS i, CAST(nt.k AS BIGINT) AS j,
            {rounded("coalesce(no.x / nt.sigma, CAST(0 AS DOUBLE))")} AS x
            FROM range(0, (SELECT max(j) + 1 FROM no)) r CROSS JOIN nt LEFT JOIN no ON no.j = r.range AND no.i = nt.i""",
        "svd_u_wide": f"""WITH {NATIONS} SELECT ns.i AS i, CAST(nt.k AS BIGINT) AS j,
            CASE WHEN ns.i = nt.i THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS x FROM ns, nt""",
        "svd_s_small": f"""WITH {NATIONS}, f AS (SELECT ln(sigma) - i / 2.0 * ln(10) AS l FROM ns),
            s AS (SELECT l, row_number() OVER (ORDER BY l DESC) - 1 AS k FROM f)
            SELECT CAST(k AS INTEGER) AS k, round(l, 3) AS ln_sigma FROM s WHERE k < 18""",
        "svd_s_brands": SIGMA_BRANDS,
        "svd_s_brands_krylov": SIGMA_BRANDS,
        "svd_s_brands_tsqr": SIGMA_BRANDS,
        "svd_s_brands_bidiagonal": SIGMA_BRANDS,
        "svd_u_brands": f"""WITH {BRANDS} SELECT bt.i, CAST(top.k AS BIGINT) AS j,
            {rounded("CASE WHEN bt.brand = top.brand THEN (x * vx + y * vy) / sigma ELSE CAST(0 AS DOUBLE) END")} AS x FROM bt, top""",
        "svd_v_brands": V_BRANDS,
        "svd_spectrum_brands": f"""WITH {BRANDS} SELECT CAST(k AS INTEGER) AS k, round(sigma, 6) AS sigma,
            round((norm - sum(l) OVER ()) / norm, 9) AS relative_error FROM top, (SELECT sum(a + d) AS norm FROM bg)""",
        "relative_error_brands": f"""WITH {BRANDS} SELECT round(norm - held, 4) AS squared_error, norm AS frobenius_sq,
            round((norm - held) / norm, 9) AS relative_error FROM be""",
        "reconstruction_error_brands": f"WITH {BRANDS} SELECT round(norm - held, 4) AS squared_error FROM be",
        "reconstruct_brands": f"""WITH {BRANDS}, q AS (SELECT i, brand, (x * vx + y * vy) AS c, vx, vy FROM bt JOIN top USING (brand))
            SELECT bt.i, CAST(s.range AS BIGINT) AS j, {rounded("coalesce(CASE WHEN s.range = 2 * q.brand THEN c * vx WHEN s.range = 2 * q.brand + 1 THEN c * vy END, CAST(0 AS DOUBLE))")} AS x
            FROM bt CROSS JOIN range(50) s LEFT JOIN q ON q.i = bt.i""",
        "sql_vec_norm": NORMS,
        "sql_vec_dot": DOT,
        "sql_vec_sqdist": SQDIST,
        "sql_vec_cells": E_ALL,
    }
    for name in LAYOUTS:
        sql = f"WITH {E}, {GRID} {assigned(name, 'e')}"
        found[f"layout_assign_{name.lower()}"] = sql
        found[f"layout_pieces_{name.lower()}"] = sql
    for name in ("MC_MR", "VC_STAR", "MR_STAR", "STAR_STAR"):
        found[f"layout_volume_{name.lower()}"] = volume(name, E, "e")
    for name in LAYOUTS:
        found[f"put_get_{name.lower()}"] = E_ALL
    found["get_rows_stored"] = found["select_rows"]
    found["project_rows_sparse"] = found["matmul"]
    found["matrix_density_sparse"] = found["matrix_density"]
    return found
