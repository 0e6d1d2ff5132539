"""Independent SQL for every registered query (run by DuckDB on the same
parquet tables).  The SQL restates each definition directly — window
``lead`` for the call graph, recursive CTEs for reachability, unrolled
rounds for the iterative algorithms — so it shares no code path with the
Spark jobs it checks.
"""

from __future__ import annotations

BASE = """
p AS (SELECT arg_min(l_partkey, (l_linenumber, l_partkey)) AS part, min(l_shipdate) AS shipped, l_orderkey,
             CAST(sum(l_quantity) AS BIGINT) AS units, max(l_returnflag) AS returned, o_custkey
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey, o_custkey),
cl AS (SELECT o_custkey AS caller,
              lead(o_custkey) OVER (PARTITION BY part ORDER BY shipped, l_orderkey) AS callee,
              shipped AS datatime, units AS duration, returned
       FROM p),
calls AS (SELECT * FROM cl WHERE callee IS NOT NULL),
edges AS (SELECT caller AS src, callee AS dst,
                 CASE WHEN min(returned) = 'R' THEN 'friend' ELSE 'follow' END AS relationship
          FROM calls GROUP BY 1, 2),
ostats AS (SELECT o_custkey, sum(o_totalprice) AS total_charges, min(o_orderdate) AS first_order,
                  max(o_orderdate) AS last_order,
                  arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority
           FROM orders GROUP BY 1),
customers AS (
  SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment, r_name AS region,
         last_priority AS priority, c_acctbal AS monthly_charges,
         round(total_charges, 2) AS total_charges,
         CAST(datediff('day', CAST(first_order AS DATE), DATE '2001-08-01') AS BIGINT) AS tenure,
         CASE WHEN last_order IS NULL OR last_order < TIMESTAMP '2001-01-01' THEN 'Yes' ELSE 'No' END AS churn,
         'P' || CAST(c_custkey AS VARCHAR) AS mobile_number
  FROM customer LEFT JOIN ostats ON c_custkey = o_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey),
verts AS (SELECT customer_id AS id, name, segment, region, priority, monthly_charges,
                 total_charges, tenure, churn FROM customers),
vedges AS (SELECT src, dst FROM edges
           WHERE src IN (SELECT id FROM verts) AND dst IN (SELECT id FROM verts))"""


def w(*ctes: str) -> str:
    """WITH clause of the base definitions plus extra CTEs."""
    parts = [BASE.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n"


def _lpa(rounds: int) -> list[str]:
    ctes = ["lab0 AS MATERIALIZED (SELECT id, id AS label FROM verts)"]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""lab{i} AS MATERIALIZED (
  WITH m AS (SELECT e.dst AS tgt, l.label FROM vedges e JOIN lab{i-1} l ON e.src = l.id
             UNION ALL
             SELECT e.src AS tgt, l.label FROM vedges e JOIN lab{i-1} l ON e.dst = l.id),
       c AS (SELECT tgt, label, count(*) AS cnt FROM m GROUP BY 1, 2),
       b AS (SELECT tgt, label FROM (SELECT tgt, label,
                row_number() OVER (PARTITION BY tgt ORDER BY cnt DESC, label) AS rn FROM c) WHERE rn = 1)
  SELECT l.id, coalesce(b.label, l.label) AS label FROM lab{i-1} l LEFT JOIN b ON l.id = b.tgt)"""
        )
    return ctes


def _pagerank(rounds: int, source: int | None = None) -> list[str]:
    ctes = [
        """ew AS MATERIALIZED (SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS w FROM vedges)"""
    ]
    if source is None:
        ctes.append("pr0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM verts)")
        reset = "0.15::DOUBLE"
    else:
        ctes.append(
            f"pr0 AS MATERIALIZED (SELECT id, CASE WHEN id = {source} THEN 1.0 ELSE 0.0 END::DOUBLE AS rank FROM verts)"
        )
        reset = f"CASE WHEN v.id = {source} THEN 0.15 ELSE 0.0 END::DOUBLE"
    for i in range(1, rounds + 1):
        ctes.append(
            f"""pr{i} AS MATERIALIZED (SELECT v.id, {reset} + 0.85::DOUBLE * coalesce(s.s, 0.0) AS rank
  FROM verts v LEFT JOIN (SELECT ew.dst, sum(r.rank * ew.w) AS s FROM ew JOIN pr{i-1} r ON ew.src = r.id
                          GROUP BY 1) s ON v.id = s.dst)"""
        )
    return ctes


def _scaled(rounds: int, personalized: bool) -> str:
    num = "1.0" if personalized else "(SELECT count(*) FROM verts)"
    return (
        f"SELECT id, round(rank * {num} / (SELECT sum(rank) FROM pr{rounds}), 6) AS pagerank FROM pr{rounds}"
    )


def _pr_tol() -> list[str]:
    return [
        "ewt AS MATERIALIZED (SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS w FROM vedges)",
        """fr AS MATERIALIZED (WITH RECURSIVE fr(id, delta, it) AS (
      SELECT id, 0.15::DOUBLE, 0 FROM verts
      UNION ALL
      SELECT ewt.dst, 0.85 * sum(fr.delta * ewt.w), fr.it + 1 FROM fr JOIN ewt ON ewt.src = fr.id
      WHERE fr.delta > 0.01 GROUP BY ewt.dst, fr.it + 1) SELECT * FROM fr)""",
        "prt AS MATERIALIZED (SELECT id, sum(delta) AS rank FROM fr GROUP BY id)",
        """prs AS (SELECT id, round(rank * (SELECT count(*) FROM verts) / (SELECT sum(rank) FROM prt), 6)
                AS pagerank FROM prt)""",
    ]


BFS_FROM = "name = 'Customer#000000001'"
BFS_TO = "segment = 'AUTOMOBILE' AND monthly_charges > 9000"


FAR_FROM = "name = 'Customer#000000002'"
FAR_TO = "segment = 'MACHINERY' AND monthly_charges > 9500"


def _bfs(edge_filter: str = "TRUE", max_len: int = 10, start: str = BFS_FROM, end: str = BFS_TO) -> str:
    return w(
        f"be AS (SELECT e.src, e.dst FROM edges e JOIN vedges v ON e.src = v.src AND e.dst = v.dst WHERE {edge_filter})",
        f"bsrc AS (SELECT id FROM verts WHERE {start})",
        f"btgt AS (SELECT id FROM verts WHERE {end})",
        f"""dist AS MATERIALIZED (SELECT id, min(k) AS k FROM (WITH RECURSIVE d(id, k) AS (
        SELECT id, 0 FROM bsrc UNION SELECT be.dst, d.k + 1 FROM d JOIN be ON be.src = d.id WHERE d.k < {max_len})
        SELECT * FROM d) GROUP BY id)""",
        "kk AS (SELECT min(dist.k) AS k FROM dist JOIN btgt ON dist.id = btgt.id)",
        """pth AS (WITH RECURSIVE pth(last, path, k) AS (
        SELECT id, CAST(id AS VARCHAR), 0 FROM bsrc
        UNION ALL
        SELECT be.dst, pth.path || '>' || CAST(be.dst AS VARCHAR), pth.k + 1
        FROM pth JOIN be ON be.src = pth.last JOIN dist ON dist.id = be.dst AND dist.k = pth.k + 1
        WHERE pth.k < (SELECT k FROM kk)) SELECT * FROM pth)""",
    ) + "SELECT path, CAST(k AS INT) AS hops FROM pth WHERE k = (SELECT k FROM kk) AND last IN (SELECT id FROM btgt)"


COMM = """cstats AS (SELECT label, (sum(CAST(round(monthly_charges * 100) AS BIGINT)) / count(monthly_charges) / 100.0) AS comm_avg_monthly_charges,
        (sum(CAST(round(total_charges * 100) AS BIGINT)) / count(total_charges) / 100.0) AS comm_avg_total_charges, (sum(CAST(round(tenure * 100) AS BIGINT)) / count(tenure) / 100.0) AS comm_avg_tenure, count(v.id) AS comm_size
      FROM verts v JOIN lab25 l ON v.id = l.id GROUP BY label)"""
COMM_DEV = """cdev AS (SELECT v.id, l.label, s.comm_avg_monthly_charges, s.comm_avg_total_charges, s.comm_avg_tenure,
        s.comm_size, s.comm_avg_monthly_charges - v.monthly_charges AS comm_dev_avg_monthly_charges,
        s.comm_avg_total_charges - v.total_charges AS comm_dev_avg_total_charges,
        s.comm_avg_tenure - v.tenure AS comm_dev_avg_tenure
      FROM verts v JOIN lab25 l ON v.id = l.id LEFT JOIN cstats s ON l.label = s.label)"""


def _nghb(direction: str) -> str:
    und = {
        "out": "SELECT src AS id, dst AS nbr FROM edges",
        "both": "SELECT src AS id, dst AS nbr FROM edges UNION ALL SELECT dst, src FROM edges",
    }[direction]
    return f"""nghb AS (SELECT u.id, (sum(CAST(round(v.monthly_charges * 100) AS BIGINT)) / count(v.monthly_charges) / 100.0) AS nghb_avg_monthly_charges,
        (sum(CAST(round(v.total_charges * 100) AS BIGINT)) / count(v.total_charges) / 100.0) AS nghb_avg_total_charges, (sum(CAST(round(v.tenure * 100) AS BIGINT)) / count(v.tenure) / 100.0) AS nghb_avg_tenure
      FROM ({und}) u LEFT JOIN verts v ON u.nbr = v.id GROUP BY u.id)"""


LOCAL = """own AS (SELECT e.src, e.dst, relationship FROM edges e JOIN customer a ON e.src = a.c_custkey
        JOIN customer b ON e.dst = b.c_custkey WHERE a.c_nationkey = b.c_nationkey),
ledges AS (SELECT src, dst FROM own UNION SELECT dst, src FROM own WHERE relationship = 'friend')"""


def _r6(cols: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _dummy(col: str, value: str) -> str:
    name = (col + "_" + value).lower().replace(" ", "_").replace("-", "_")
    return f"CAST(CASE WHEN {col} = '{value}' THEN 1 ELSE 0 END AS BIGINT) AS {name}"


USERS = """ru AS (SELECT c_custkey AS id, lower(split_part(c_name, '#', 1)) AS firstname,
        'n' || split_part(c_name, '#', 2) AS lastname,
        lower(replace(c_name, '#', '.')) || '@mail.example' AS email, c_mktsegment AS canal, n_name AS country,
        strftime(first_o, '%m-%d-%Y %-H:%M:%S') AS creation_date,
        strftime(last_o, '%m-%d-%Y %H:%M:%S') AS last_activity_date,
        CASE WHEN c_acctbal >= 4500 THEN 1.0 ELSE 0.0 END::DOUBLE AS gender,
        (floor((c_acctbal + 1000) / 1100) + 1)::DOUBLE AS age_group
      FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_o, max(o_orderdate) AS last_o
                               FROM orders GROUP BY 1) s ON c_custkey = s.o_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey),
su AS (SELECT id AS user_id, upper(firstname[1:1]) || lower(firstname[2:]) AS firstname_i, firstname, lastname, sha1(email) AS email,
        canal, country, strptime(creation_date, '%m-%d-%Y %H:%M:%S') AS creation_date,
        strptime(last_activity_date, '%m-%d-%Y %H:%M:%S') AS last_activity_date,
        CAST(trunc(gender) AS INT) AS gender, CAST(trunc(age_group) AS INT) AS age_group FROM ru)"""
ORDERS = """ro AS (SELECT o_custkey AS user_id, o_orderkey AS id, strftime(o_orderdate, '%m-%d-%Y %-H:%M:%S') AS transaction_date,
        coalesce(n, 0)::DOUBLE AS item_count, o_totalprice AS amount
      FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) li ON o_orderkey = l_orderkey),
so AS (SELECT user_id, id AS order_id, transaction_date, CAST(trunc(item_count) AS INT) AS item_count,
        CAST(trunc(amount) AS INT) AS amount, strptime(transaction_date, '%m-%d-%Y %H:%M:%S') AS creation_date FROM ro)"""
EVENTS = """re AS (SELECT user_id, event_id, event_type AS platform, strftime(ts, '%m-%d-%Y %H:%M:%S') AS date,
        event_type AS action, json_extract_string(props, '$.k') AS session_id,
        'https://shop.example/' || event_type AS url FROM events)"""
OSTATS = """ost AS (SELECT user_id, count(*) AS order_count, sum(amount) AS total_amount, sum(item_count) AS total_item,
        max(creation_date) AS last_transaction FROM so GROUP BY 1)"""
ESTATS = """est AS (SELECT user_id, arg_min(platform, (strptime(date, '%m-%d-%Y %H:%M:%S'), event_id)) AS platform,
        count(*) AS event_count, count(DISTINCT session_id) AS session_count,
        max(strptime(date, '%m-%d-%Y %H:%M:%S')) AS last_event FROM re GROUP BY 1)"""


def sql() -> dict[str, str]:
    o: dict[str, str] = {}
    o["call_edges"] = w(
        "pairs AS (SELECT DISTINCT 'P' || CAST(caller AS VARCHAR) AS a, 'P' || CAST(callee AS VARCHAR) AS b FROM calls)"
    ) + """SELECT DISTINCT c2.customer_id AS dst, c1.customer_id AS src
FROM pairs LEFT JOIN customers c1 ON pairs.a = c1.mobile_number
           LEFT JOIN customers c2 ON pairs.b = c2.mobile_number"""
    o["in_degrees"] = w() + "SELECT dst AS id, count(*) AS inDegree FROM edges GROUP BY 1"
    o["out_degrees"] = w() + "SELECT src AS id, count(*) AS outDegree FROM edges GROUP BY 1"
    o["degrees"] = w() + (
        "SELECT id, count(*) AS degree FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY 1"
    )
    o["degrees_ranked"] = o["degrees"]
    o["in_degrees_ranked"] = o["in_degrees"]
    o["out_degrees_ranked"] = o["out_degrees"]
    o["degrees_top"] = o["degrees"] + " ORDER BY degree DESC, id LIMIT 20"
    o["degree_ratios"] = w(
        """d AS (SELECT id, count(*) AS degree, sum(i) AS in_degree, sum(o) AS out_degree FROM (
      SELECT src AS id, 0 AS i, 1 AS o FROM edges UNION ALL SELECT dst, 1, 0 FROM edges) GROUP BY 1)"""
    ) + """SELECT v.id, coalesce(degree, 0) AS degree, CAST(coalesce(in_degree, 0) AS BIGINT) AS in_degree,
       CAST(coalesce(out_degree, 0) AS BIGINT) AS out_degree,
       CAST(CASE WHEN coalesce(degree, 0) = 0 THEN 0.0 ELSE in_degree / degree END AS FLOAT) AS in_degree_ratio,
       CAST(CASE WHEN coalesce(degree, 0) = 0 THEN 0.0 ELSE out_degree / degree END AS FLOAT) AS out_degree_ratio
FROM verts v LEFT JOIN d ON v.id = d.id"""
    o["neighbors"] = w() + (
        "SELECT DISTINCT id, neighbor FROM (SELECT src AS id, dst AS neighbor FROM edges "
        "UNION ALL SELECT dst, src FROM edges)"
    )
    o["youngest"] = w() + "SELECT min(tenure) AS min_tenure FROM verts"
    o["edge_filter_count"] = w() + "SELECT count(*) AS follow_edges FROM edges WHERE relationship = 'follow'"
    o["reciprocal_pairs"] = w() + """SELECT e1.src AS a_id, e1.dst AS b_id
FROM edges e1 JOIN edges e2 ON e1.dst = e2.src AND e1.src = e2.dst
JOIN verts a ON a.id = e1.src JOIN verts b ON b.id = e1.dst
WHERE a.monthly_charges > 5000 OR b.monthly_charges > 5000"""
    o["chain4_friends"] = w() + """SELECT a_id, b_id, c_id, d_id, num_friends FROM (
  SELECT e1.src AS a_id, e1.dst AS b_id, e2.dst AS c_id, e3.dst AS d_id,
         CAST((e1.relationship = 'friend')::INT + (e2.relationship = 'friend')::INT
              + (e3.relationship = 'friend')::INT AS INT) AS num_friends
  FROM edges e1 JOIN edges e2 ON e1.dst = e2.src JOIN edges e3 ON e2.dst = e3.src
  WHERE e1.src IN (SELECT id FROM verts) AND e1.dst IN (SELECT id FROM verts)
    AND e2.dst IN (SELECT id FROM verts) AND e3.dst IN (SELECT id FROM verts))
WHERE num_friends >= 2"""
    o["one_way_edges"] = w() + """SELECT e.src AS a_id, e.dst AS b_id FROM edges e
WHERE NOT EXISTS (SELECT 1 FROM edges r WHERE r.src = e.dst AND r.dst = e.src)
  AND e.src IN (SELECT id FROM verts) AND e.dst IN (SELECT id FROM verts)"""
    sub = w(
        "sv AS (SELECT * FROM verts WHERE monthly_charges > 3000)",
        """se AS (SELECT src, dst, relationship FROM edges WHERE relationship = 'friend'
               AND src IN (SELECT id FROM sv) AND dst IN (SELECT id FROM sv))""",
    )
    o["subgraph_vertices"] = sub + """SELECT id, name, monthly_charges FROM sv
WHERE id IN (SELECT src FROM se) OR id IN (SELECT dst FROM se)"""
    o["subgraph_edges"] = sub + "SELECT src, dst, relationship FROM se"
    o["connected_components"] = w(
        "und AS (SELECT src AS a, dst AS b FROM vedges UNION SELECT dst, src FROM vedges)",
        """r AS (WITH RECURSIVE r(node, lbl) AS (SELECT id, id FROM verts
               UNION SELECT und.b, r.lbl FROM r JOIN und ON r.node = und.a) SELECT * FROM r)""",
    ) + "SELECT node AS id, min(lbl) AS component FROM r GROUP BY 1"
    o["scc"] = w(
        "de AS (SELECT DISTINCT src AS a, dst AS b FROM vedges)",
        """r AS (WITH RECURSIVE r(s, d) AS (SELECT a, b FROM de
               UNION SELECT r.s, de.b FROM r JOIN de ON r.d = de.a) SELECT * FROM r)""",
        """lab AS (SELECT r1.s AS id, min(r1.d) AS comp FROM r r1 JOIN r r2 ON r1.s = r2.d AND r1.d = r2.s
                GROUP BY 1)""",
    ) + "SELECT v.id, least(v.id, coalesce(lab.comp, v.id)) AS component FROM verts v LEFT JOIN lab ON v.id = lab.id"
    o["label_propagation_5"] = w(*_lpa(5)) + "SELECT id, label FROM lab5"
    o["community_stats"] = w(*_lpa(25)) + """SELECT label,
  round((sum(CAST(round(monthly_charges * 100) AS BIGINT)) / count(monthly_charges) / 100.0), 6) AS comm_avg_monthly_charges,
  round((sum(CAST(round(total_charges * 100) AS BIGINT)) / count(total_charges) / 100.0), 6) AS comm_avg_total_charges,
  round((sum(CAST(round(tenure * 100) AS BIGINT)) / count(tenure) / 100.0), 6) AS comm_avg_tenure, count(v.id) AS comm_size
FROM verts v JOIN lab25 l ON v.id = l.id GROUP BY label"""
    o["pagerank_10"] = w(*_pagerank(10)) + _scaled(10, False)
    o["pagerank_personalized"] = w(*_pagerank(10, source=1)) + _scaled(10, True)
    o["pagerank_edges"] = w() + """SELECT src, dst, relationship, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS weight FROM edges"""
    o["pregel_pagerank"] = w(
        "od AS MATERIALIZED (SELECT src AS id, count(*) AS outDegree FROM edges GROUP BY 1)",
        "pv0 AS MATERIALIZED (SELECT id, outDegree, 1.0::DOUBLE / (SELECT count(*) FROM verts) AS rank FROM od)",
        *[
            f"""pv{i} AS MATERIALIZED (SELECT v.id, v.outDegree,
  coalesce(m.s, 0.0) * 0.85 + 0.15 / (SELECT count(*) FROM verts) AS rank
  FROM pv{i-1} v LEFT JOIN (SELECT e.dst, sum(s.rank / s.outDegree) AS s
     FROM edges e JOIN pv{i-1} s ON e.src = s.id JOIN pv{i-1} t ON e.dst = t.id GROUP BY 1) m ON v.id = m.dst)"""
            for i in range(1, 6)
        ],
    ) + "SELECT id, outDegree, round(rank, 9) AS rank FROM pv5"
    o["triangle_count"] = w(
        "und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM vedges WHERE src <> dst)",
        """t AS (SELECT x.a AS p, x.b AS q, y.b AS r FROM und x JOIN und y ON x.a = y.a AND x.b < y.b
              JOIN und z ON z.a = x.b AND z.b = y.b)""",
        "c AS (SELECT id, count(*) AS n FROM (SELECT p AS id FROM t UNION ALL SELECT q FROM t UNION ALL SELECT r FROM t) GROUP BY 1)",
    ) + "SELECT v.id, coalesce(c.n, 0) AS count FROM verts v LEFT JOIN c ON v.id = c.id"
    o["clustering_coefficient"] = o["triangle_count"].replace(
        "SELECT v.id, coalesce(c.n, 0) AS count FROM verts v LEFT JOIN c ON v.id = c.id",
        """, tc AS (SELECT v.id, coalesce(c.n, 0) AS count FROM verts v LEFT JOIN c ON v.id = c.id),
dg AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY 1)
SELECT tc.id, tc.count, dg.degree,
  CAST(CASE WHEN tc.count = 0 OR dg.degree = 0 THEN 0.0 ELSE tc.count / (dg.degree * (dg.degree - 1) / 2.0) END AS FLOAT) AS cc
FROM tc JOIN dg ON tc.id = dg.id""",
    ).replace("SELECT v.id, coalesce", "SELECT v.id, coalesce", 1)
    # the replace above turns the final SELECT into a CTE chain; fix the leading comma join
    o["clustering_coefficient"] = o["clustering_coefficient"].replace("\n, tc AS", ",\ntc AS")
    o["bfs_paths"] = _bfs()
    o["bfs_filtered"] = _bfs("e.relationship <> 'friend'", 3)
    o["shortest_paths"] = w(
        "lm AS (SELECT dst AS id FROM edges GROUP BY dst ORDER BY count(*) DESC, dst LIMIT 3)",
        """sp AS (WITH RECURSIVE s(id, landmark, k) AS (SELECT id, id, 0 FROM lm
        UNION SELECT e.src, s.landmark, s.k + 1 FROM s JOIN vedges e ON e.dst = s.id WHERE s.k < 100)
        SELECT * FROM s)""",
    ) + "SELECT id, landmark, CAST(min(k) AS INT) AS distance FROM sp GROUP BY 1, 2"
    o["pagerank_tol"] = w(*_pr_tol()) + "SELECT id, pagerank FROM prs"
    cd_cols = ["comm_avg_monthly_charges", "comm_avg_total_charges", "comm_avg_tenure",
               "comm_dev_avg_monthly_charges", "comm_dev_avg_total_charges", "comm_dev_avg_tenure"]
    o["community_deviation"] = w(*_lpa(25), COMM, COMM_DEV) + (
        f"SELECT id, label, comm_size, {_r6(cd_cols)} FROM cdev"
    )
    nb_cols = ["nghb_avg_monthly_charges", "nghb_avg_total_charges", "nghb_avg_tenure"]
    o["neighbor_avg_out"] = w(_nghb("out")) + f"SELECT id, {_r6(nb_cols)} FROM nghb"
    o["neighbor_avg_both"] = w(_nghb("both")) + f"SELECT id, {_r6(nb_cols)} FROM nghb"
    o["graph_features"] = w(
        *_lpa(25), COMM, COMM_DEV, _nghb("out"), *_pr_tol(),
        """dg AS (SELECT id, count(*) AS degree, sum(i) AS in_degree, sum(o) AS out_degree FROM (
      SELECT src AS id, 0 AS i, 1 AS o FROM edges UNION ALL SELECT dst, 1, 0 FROM edges) GROUP BY 1)""",
        "und AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM vedges WHERE src <> dst)",
        """tri AS (SELECT x.a AS p, x.b AS q, y.b AS r FROM und x JOIN und y ON x.a = y.a AND x.b < y.b
              JOIN und z ON z.a = x.b AND z.b = y.b)""",
        "tc AS (SELECT id, count(*) AS n FROM (SELECT p AS id FROM tri UNION ALL SELECT q FROM tri UNION ALL SELECT r FROM tri) GROUP BY 1)",
        """base AS (SELECT v.id AS customer_id, coalesce(dg.degree, 0) AS degree,
        CAST(coalesce(dg.in_degree, 0) AS BIGINT) AS in_degree, CAST(coalesce(dg.out_degree, 0) AS BIGINT) AS out_degree,
        coalesce(tc.n, 0) AS trian_count, coalesce(prs.pagerank, 0.0) AS pagerank
      FROM verts v LEFT JOIN dg ON v.id = dg.id LEFT JOIN tc ON v.id = tc.id LEFT JOIN prs ON v.id = prs.id)""",
    ) + f"""SELECT b.customer_id, b.degree, b.in_degree, b.out_degree,
  CAST(CASE WHEN b.degree = 0 THEN 0.0 ELSE b.in_degree / b.degree END AS FLOAT) AS in_degree_ratio,
  CAST(CASE WHEN b.degree = 0 THEN 0.0 ELSE b.out_degree / b.degree END AS FLOAT) AS out_degree_ratio,
  b.pagerank, b.trian_count,
  CAST(CASE WHEN b.trian_count = 0 OR b.degree = 0 THEN 0.0
            ELSE b.trian_count / (b.degree * (b.degree - 1) / 2.0) END AS FLOAT) AS cc,
  round(coalesce(c.comm_avg_monthly_charges, 0), 6) AS comm_avg_monthly_charges,
  round(coalesce(c.comm_avg_total_charges, 0), 6) AS comm_avg_total_charges,
  round(coalesce(c.comm_avg_tenure, 0), 6) AS comm_avg_tenure,
  coalesce(c.comm_size, 0) AS comm_size,
  round(coalesce(c.comm_dev_avg_monthly_charges, 0), 6) AS comm_dev_avg_monthly_charges,
  round(coalesce(c.comm_dev_avg_total_charges, 0), 6) AS comm_dev_avg_total_charges,
  round(coalesce(c.comm_dev_avg_tenure, 0), 6) AS comm_dev_avg_tenure,
  round(coalesce(n.nghb_avg_monthly_charges, 0), 6) AS nghb_avg_monthly_charges,
  round(coalesce(n.nghb_avg_total_charges, 0), 6) AS nghb_avg_total_charges,
  round(coalesce(n.nghb_avg_tenure, 0), 6) AS nghb_avg_tenure
FROM base b LEFT JOIN cdev c ON b.customer_id = c.id LEFT JOIN nghb n ON b.customer_id = n.id"""
    dummies = ", ".join(
        [_dummy("segment", v) for v in SEGMENTS] + [_dummy("region", v) for v in REGIONS]
        + [_dummy("priority", v) for v in PRIORITIES]
    )
    o["customer_features"] = w() + f"""SELECT customer_id, monthly_charges, total_charges, tenure,
  CAST(CASE churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INT) AS churn, {dummies}
FROM customers
WHERE customer_id IS NOT NULL AND monthly_charges IS NOT NULL AND total_charges IS NOT NULL
  AND tenure IS NOT NULL AND churn IS NOT NULL"""
    o["column_cleanup"] = w() + """SELECT customer_id, segment, region, monthly_charges,
  TRY_CAST(CASE WHEN monthly_charges < 0 THEN ' ' ELSE CAST(total_charges AS VARCHAR) END AS DOUBLE) AS total_charges,
  tenure, churn FROM customers"""
    o["try_cast_clean"] = w() + """SELECT segment, count(*) AS n,
  sum(CASE WHEN monthly_charges < 0 OR total_charges IS NULL THEN 1 ELSE 0 END) AS blank_totals,
  round(sum(CASE WHEN monthly_charges < 0 THEN NULL ELSE CAST(round(total_charges * 100) AS BIGINT) END) / 100.0, 2) AS sum_totals
FROM customers GROUP BY 1"""
    o["category_counts"] = w() + "SELECT segment, churn, count(*) AS n FROM customers GROUP BY 1, 2"
    o["contract_share"] = w() + """SELECT priority, n, round(n / sum(n) OVER (), 6) AS share
FROM (SELECT priority, count(*) AS n FROM customers GROUP BY 1)"""
    o["histogram"] = w() + "SELECT CAST(floor(tenure / 100.0) AS BIGINT) AS bin, churn, count(*) AS n FROM customers GROUP BY 1, 2"
    prof = []
    for c in ["monthly_charges", "total_charges", "tenure"]:
        prof.append(f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS nulls,
  count(DISTINCT {c}) AS distinct_count, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max,
  round(avg({c}::DOUBLE), 4) AS mean, round(stddev_samp({c}::DOUBLE), 4) AS std FROM customers""")
    o["profile"] = w() + "\nUNION ALL\n".join(prof)
    tv = []
    for c in ["segment", "region", "priority", "churn"]:
        tv.append(f"""SELECT '{c}' AS "column", value, n FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n,
  row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS rn FROM customers WHERE {c} IS NOT NULL GROUP BY 1)
  WHERE rn = 1""")
    o["top_values"] = w() + "\nUNION ALL\n".join(tv)
    o["order_stats"] = w(ORDERS, OSTATS) + "SELECT * FROM ost"
    o["event_stats"] = w(EVENTS, ESTATS) + "SELECT * FROM est"
    o["activity_features"] = w(USERS, ORDERS, EVENTS, OSTATS, ESTATS) + """SELECT su.user_id,
  su.firstname_i AS firstname, upper(su.lastname[1:1]) || lower(su.lastname[2:]) AS lastname, su.email, su.canal, su.country,
  su.creation_date, su.last_activity_date, su.gender, su.age_group,
  ost.order_count, ost.total_amount, ost.total_item, ost.last_transaction,
  est.platform, est.event_count, est.session_count, est.last_event,
  CAST(datediff('day', CAST(su.creation_date AS DATE), DATE '2024-02-01') AS INT) AS days_since_creation,
  CAST(datediff('day', CAST(su.last_activity_date AS DATE), DATE '2024-02-01') AS INT) AS days_since_last_activity,
  CAST(datediff('day', CAST(est.last_event AS DATE), DATE '2024-02-01') AS INT) AS days_last_event
FROM su JOIN ost ON su.user_id = ost.user_id JOIN est ON su.user_id = est.user_id"""
    o["churn_rule"] = w(USERS, ORDERS, EVENTS) + """, act AS (SELECT user_id,
    arg_min(platform, (strptime(date, '%m-%d-%Y %H:%M:%S'), event_id)) AS first_platform,
    count(*) AS action_count FROM re GROUP BY 1),
  od AS (SELECT user_id, sum(item_count) AS sum_item_count, count(*) AS order_count FROM ro GROUP BY 1)
SELECT od.user_id, od.order_count, od.sum_item_count, act.action_count, act.first_platform,
  5 + CASE WHEN (od.order_count >= 5 AND first_platform = 'purchase')
    OR (od.order_count = 3 AND gender = 0)
    OR (od.order_count = 2 AND gender = 1 AND age_group <= 3)
    OR (sum_item_count <= 1 AND first_platform = 'view')
    OR (sum_item_count >= 10 AND first_platform = 'purchase')
    OR action_count >= 4
    OR country = 'NATION_24'
    OR datediff('day', CAST(strptime(creation_date, '%m-%d-%Y %H:%M:%S') AS DATE), DATE '2024-02-01') >= 90
    OR (age_group >= 7 AND gender = 0)
    OR (age_group <= 2 AND gender = 1) THEN 80 ELSE 20 END AS churn_proba
FROM od JOIN act ON od.user_id = act.user_id JOIN ru ON od.user_id = ru.id"""
    o["stream_activity_features"] = o["activity_features"]
    o["activity_features_sql"] = o["activity_features"]
    o["stream_ingest_orders"] = w(ORDERS) + "SELECT * FROM so"
    o["stream_users"] = w(USERS) + """SELECT user_id, firstname_i AS firstname,
  upper(lastname[1:1]) || lower(lastname[2:]) AS lastname, email, canal, country, creation_date,
  last_activity_date, gender, age_group FROM su"""
    o["stream_events"] = w(EVENTS) + "SELECT * FROM re"
    o["latest_order"] = w() + """SELECT o_custkey AS customer_id,
  arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
  max(o_orderdate) AS o_orderdate,
  arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice
FROM orders GROUP BY o_custkey"""
    split = """CAST(('0x' || substr(md5(CAST(customer_id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100 AS BIGINT)"""
    o["split_counts"] = w() + f"""SELECT CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'val' ELSE 'test' END AS split,
  churn, count(*) AS n FROM (SELECT churn, {split} AS b FROM customers) GROUP BY 1, 2"""
    sc = """sc AS (SELECT customer_id, CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS label,
        (monthly_charges + 1000.0) / 11000.0 AS score FROM customers)"""
    o["confusion_matrix"] = w(sc) + """SELECT label, CAST(score >= 0.5 AS INT) AS prediction, count(*) AS n FROM sc GROUP BY 1, 2"""
    bk = """bk AS (SELECT score AS threshold, sum(label)::DOUBLE AS pos,
        sum(1 - label)::DOUBLE AS neg FROM sc GROUP BY 1),
cum AS (SELECT threshold,
        sum(pos) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
        sum(neg) OVER (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
        sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM bk)"""
    o["roc_points"] = w(sc, bk) + "SELECT round(threshold, 6) AS threshold, round(fp / N, 9) AS fpr, round(tp / P, 9) AS tpr FROM cum"
    o["pr_points"] = w(sc, bk) + """SELECT round(threshold, 6) AS threshold, round(tp / P, 9) AS recall,
  round(tp / (tp + fp), 9) AS precision FROM cum"""
    o["roc_auc"] = w(sc, bk) + """, pts AS (SELECT threshold, fp / N AS fpr, tp / P AS tpr FROM cum),
lg AS (SELECT fpr, tpr, coalesce(lag(fpr) OVER (ORDER BY threshold DESC), 0.0) AS f0,
        coalesce(lag(tpr) OVER (ORDER BY threshold DESC), 0.0) AS t0 FROM pts)
SELECT round(sum((fpr - f0) * (tpr + t0) / 2), 9) AS auc FROM lg"""
    ue = """ue AS (SELECT DISTINCT c2.customer_id AS dst, c1.customer_id AS src
  FROM (SELECT DISTINCT 'P' || CAST(caller AS VARCHAR) AS a, 'P' || CAST(callee AS VARCHAR) AS b FROM calls) pairs
  LEFT JOIN (SELECT * FROM customers WHERE monthly_charges >= 0) c1 ON pairs.a = c1.mobile_number
  LEFT JOIN (SELECT * FROM customers WHERE monthly_charges >= 0) c2 ON pairs.b = c2.mobile_number)"""
    o["call_edges_unmatched"] = w(ue) + "SELECT dst, src FROM ue"
    o["unmatched_degrees"] = w(ue) + (
        "SELECT id, count(*) AS degree FROM (SELECT src AS id FROM ue UNION ALL SELECT dst FROM ue) GROUP BY 1")
    o["profile_quantiles"] = w() + "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", quantile_disc({c}::DOUBLE, 0.25) AS p25,
  quantile_disc({c}::DOUBLE, 0.5) AS p50, quantile_disc({c}::DOUBLE, 0.75) AS p75 FROM customers"""
        for c in ["monthly_charges", "total_charges", "tenure"])
    o["training_set"] = (
        "SELECT * FROM (" + o["customer_features"] + ") cf LEFT JOIN (" + o["graph_features"]
        + ") gf USING (customer_id)"
    )
    o["customers_with_numbers"] = w() + """SELECT * REPLACE (
  CASE WHEN monthly_charges >= 0 THEN mobile_number END AS mobile_number) FROM customers"""
    o["calls_by_month"] = w() + """SELECT strftime(datatime, '%Y-%m') AS month, count(*) AS calls,
  CAST(sum(duration) AS BIGINT) AS duration FROM calls GROUP BY 1"""
    for name in ("connected_components", "scc"):
        local = {"connected_components": "local_components"}.get(name, "local_scc")
        o[local] = o[name].replace(BASE.strip(), BASE.strip() + ",\n" + LOCAL, 1).replace("FROM vedges", "FROM ledges")
    o["local_communities"] = w(LOCAL, *[c.replace("vedges", "ledges") for c in _lpa(25)], COMM, COMM_DEV) + (
        f"SELECT id, label, comm_size, {_r6(cd_cols)} FROM cdev")
    o["bfs_far"] = _bfs(start=FAR_FROM, end=FAR_TO)
    o["bfs_far_filtered"] = _bfs("e.relationship <> 'friend'", 5, FAR_FROM, FAR_TO)
    o["bfs_structs"] = (
        _bfs(start=FAR_FROM, end=FAR_TO)
        .replace("SELECT e.src, e.dst FROM edges e JOIN", "SELECT e.src, e.dst, e.relationship AS rel FROM edges e JOIN")
        .replace("SELECT id, CAST(id AS VARCHAR), 0 FROM bsrc", "SELECT id, name, 0 FROM bsrc JOIN verts USING (id)")
        .replace("pth.path || '>' || CAST(be.dst AS VARCHAR)", "pth.path || '>' || be.rel || '>' || tv.name")
        .replace("FROM pth JOIN be ON be.src = pth.last", "FROM pth JOIN be ON be.src = pth.last JOIN verts tv ON tv.id = be.dst")
        .replace("SELECT path, CAST(k AS INT) AS hops FROM", "SELECT path FROM"))
    o["distance_maps"] = ("SELECT v.c_custkey AS id, coalesce(string_agg(s.cell, ',' ORDER BY s.cell), '') AS distances "
                          "FROM customer v LEFT JOIN (SELECT id, CAST(landmark AS VARCHAR) || ':' || CAST(distance AS VARCHAR) "
                          "AS cell FROM (" + o["shortest_paths"] + ")) s ON v.c_custkey = s.id GROUP BY 1")
    o["csv_customers"] = w() + "SELECT customer_id, segment, monthly_charges, tenure, churn FROM customers"
    o["append_and_delete"] = """SELECT o_orderkey, o_totalprice, o_orderdate,
  CASE WHEN year(o_orderdate) >= 1998 THEN o_orderstatus END AS o_orderstatus FROM orders WHERE o_totalprice >= 100000"""
    drawn = """lu AS (SELECT ru.*, concat_ws(' ', id % 997 + 1, upper(canal[1:1]) || lower(canal[2:]), 'Street,', country) AS address,
        ('0x' || substr(md5(CAST(id AS VARCHAR) || ':42'), 1, 8))::BIGINT / 4294967296.0 * 100 < churn_proba AS churn
      FROM ru LEFT JOIN (""" + o["churn_rule"] + """) pr ON ru.id = pr.user_id)"""
    o["labelled_users"] = w(USERS, drawn) + "SELECT * FROM lu"
    o["stream_churn_features"] = ("SELECT af.*, lu.address, CAST(lu.churn AS INT) AS churn FROM (" + o["activity_features"]
                                  + ") af JOIN (" + o["labelled_users"] + ") lu ON af.user_id = lu.id")
    o["stream_schema_evolution"] = """SELECT o_custkey AS user_id, o_orderkey AS id, o_totalprice AS amount,
  CASE WHEN year(o_orderdate) >= 2000 THEN o_orderstatus END AS status,
  CASE WHEN year(o_orderdate) >= 2000 THEN CAST(o_orderpriority[1:1] AS BIGINT) END AS urgency,
  CASE WHEN year(o_orderdate) BETWEEN 1997 AND 1999
       THEN '{"status":"' || o_orderstatus || '","urgency":"' || o_orderpriority[1:1] || '"}' END AS _rescued_data
FROM orders"""
    o["neighbor_pieces"] = w(
        """np AS (SELECT DISTINCT id, neighbor FROM (SELECT src AS id, dst AS neighbor FROM edges
              UNION ALL SELECT dst, src FROM edges))""",
        "nr AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY neighbor) - 1 AS rn FROM np)",
    ) + """SELECT id, CAST(rn // 10 AS INT) AS piece, string_agg(CAST(neighbor AS VARCHAR), ',' ORDER BY neighbor) AS neighbors
FROM nr GROUP BY 1, 2"""
    o["neighbor_pieces_strict"] = sub.rstrip() + """,
np AS (SELECT DISTINCT id, neighbor FROM (SELECT src AS id, dst AS neighbor FROM se UNION ALL SELECT dst, src FROM se)),
nr AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY neighbor) - 1 AS rn FROM np),
both_ways AS (SELECT src AS id FROM se INTERSECT SELECT dst FROM se)
SELECT id, CAST(rn // 10 AS INT) AS piece, string_agg(CAST(neighbor AS VARCHAR), ',' ORDER BY neighbor) AS neighbors
FROM nr WHERE id IN (SELECT id FROM both_ways) GROUP BY 1, 2
UNION ALL
SELECT DISTINCT id, 0, NULL FROM np WHERE id NOT IN (SELECT id FROM both_ways)"""
    o["pregel_two_way"] = w(
        "near AS (SELECT src AS a, dst AS b FROM vedges UNION SELECT dst, src FROM vedges UNION SELECT id, id FROM verts)",
        "h1 AS (SELECT a, min(b) AS least, max(monthly_charges) AS most FROM near JOIN verts ON b = id GROUP BY a)",
        "h2 AS (SELECT n.a, min(least) AS least, max(most) AS most FROM near n JOIN h1 ON n.b = h1.a GROUP BY n.a)",
        "h3 AS (SELECT n.a, min(least) AS least, max(most) AS most FROM near n JOIN h2 ON n.b = h2.a GROUP BY n.a)",
    ) + "SELECT a AS id, least, most FROM h3"
    o["categories_by_total"] = w() + """SELECT priority, churn, n, CAST(total AS BIGINT) AS total,
  dense_rank() OVER (ORDER BY total DESC, priority NULLS FIRST) AS place
FROM (SELECT priority, churn, count(*) AS n, sum(count(*)) OVER (PARTITION BY priority) AS total
      FROM customers GROUP BY 1, 2)"""
    o["sample_with_replacement"] = w(
        """placed AS (SELECT customer_id, priority, churn, row_number() OVER (
              ORDER BY md5(CAST(customer_id AS VARCHAR) || ':123')) - 1 AS place FROM customers)""",
        """draws AS (SELECT ('0x' || substr(md5(CAST(i AS VARCHAR) || ':123'), 1, 15))::BIGINT
              % (SELECT count(*) FROM customers) AS place FROM range(10000) t(i))""",
    ) + """SELECT customer_id, priority, churn, count(*) AS times FROM draws JOIN placed USING (place) GROUP BY 1, 2, 3"""
    o["degree_places"] = o["degrees"].replace("SELECT id, count(*) AS degree FROM (", """SELECT id, degree,
  row_number() OVER (ORDER BY degree DESC, id) AS place FROM (SELECT id, count(*) AS degree FROM (""", 1) + ")"
    o["triangle_places"] = ("SELECT id, count, row_number() OVER (ORDER BY count DESC, id) AS place FROM ("
                            + o["triangle_count"] + ")")
    scs = f"""scs AS (SELECT sc.*, CAST(score >= 0.5 AS INT) AS prediction, CASE WHEN b < 60 THEN 'train'
        WHEN b < 80 THEN 'val' ELSE 'test' END AS split FROM (SELECT *, {split} AS b FROM sc) sc)"""
    o["classification_metrics"] = w(sc, scs) + """, bk AS (SELECT split, score AS t, sum(label)::DOUBLE AS pos,
    sum(1 - label)::DOUBLE AS neg FROM scs GROUP BY 1, 2),
cum AS (SELECT split, t, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER a AS p, sum(neg) OVER a AS n FROM bk
        WINDOW w AS (PARTITION BY split ORDER BY t DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               a AS (PARTITION BY split)),
pts AS (SELECT split, t, tp / p AS rec, fp / n AS fpr, tp / (tp + fp) AS pre FROM cum),
seg AS (SELECT *, coalesce(lag(rec) OVER w, 0) AS rec0, coalesce(lag(fpr) OVER w, 0) AS fpr0,
               coalesce(lag(pre) OVER w, pre) AS pre0 FROM pts WINDOW w AS (PARTITION BY split ORDER BY t DESC)),
area AS (SELECT split, sum((fpr - fpr0) * (rec + rec0) / 2) AS roc, sum((rec - rec0) * (pre + pre0) / 2) AS pr
         FROM seg GROUP BY 1),
cnt AS (SELECT split, count(*) AS n, sum((label = prediction)::INT) AS ok, sum((label = 1 AND prediction = 1)::INT) AS hit,
          sum(prediction) AS said, sum(label) AS is_one, avg(CASE WHEN label = 1
            THEN -ln(greatest(least(score, 1 - 1e-15), 1e-15)) ELSE -ln(1 - greatest(least(score, 1 - 1e-15), 1e-15)) END) AS ll
        FROM scs GROUP BY 1)
SELECT split, n, round(ok / n, 9) AS accuracy, round(hit / said, 9) AS precision, round(hit / is_one, 9) AS recall,
  round(2 * hit / (said + is_one), 9) AS f1, round(ll, 9) AS log_loss, round(roc, 9) AS roc_auc, round(pr, 9) AS pr_auc
FROM cnt JOIN area USING (split)"""
    o["shapley_linear"] = w(
        f"""ok AS (SELECT *, CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'val' ELSE 'test' END AS split
            FROM (SELECT *, {split} AS b FROM customers)
            WHERE monthly_charges IS NOT NULL AND total_charges IS NOT NULL AND tenure IS NOT NULL)""",
        """x AS (SELECT * FROM ok WHERE split = 'val'
              ORDER BY md5(CAST(customer_id AS VARCHAR) || ':1'), customer_id LIMIT 100)""",
        """bg AS (SELECT * FROM ok WHERE split = 'train'
              ORDER BY md5(CAST(customer_id AS VARCHAR) || ':2'), customer_id LIMIT 100)""",
        """m AS (SELECT avg(monthly_charges) AS mc, avg(total_charges) AS tc, avg(tenure) AS te FROM bg)""",
    ) + """SELECT customer_id, f.feature, round(CASE f.feature WHEN 'monthly_charges' THEN 0.001 * (monthly_charges - mc)
    WHEN 'total_charges' THEN -0.00002 * (total_charges - tc) ELSE 0.003 * (tenure - te) END, 6) AS contribution,
  round(1.0 + 0.001 * mc - 0.00002 * tc + 0.003 * te, 6) AS base
FROM x, m, (VALUES ('monthly_charges'), ('total_charges'), ('tenure')) f(feature)"""
    o["sample_preview"] = w() + """SELECT customer_id, segment, monthly_charges, churn FROM customers
ORDER BY md5(CAST(customer_id AS VARCHAR) || ':123'), customer_id LIMIT 100"""
    return o
