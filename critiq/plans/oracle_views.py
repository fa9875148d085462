"""DuckDB forms of the derived views, used to build the oracle SQL.

Each constant is a CTE body over the provided tables; ``with_views`` prefixes a
query with the CTEs it names, in dependency order.
"""

from __future__ import annotations

REVIEWS = """
SELECT CASE WHEN (l_partkey // 4) % 2 = 0 THEN 'PUB_A' ELSE 'PUB_B' END AS publisher,
       CASE l_linenumber % 5 WHEN 0 THEN 'Paperback' WHEN 1 THEN 'Hardcover' WHEN 2 THEN 'Kindle'
            WHEN 3 THEN 'Omnibus' ELSE 'Collector or Limited Edition' END AS version,
       CAST(l_linenumber % 5 AS INTEGER) AS vrank,
       l_partkey - l_partkey % 4 AS umbrella_item,
       l_partkey AS review_item,
       o_custkey AS user_id,
       CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating,
       CAST(epoch(l_shipdate) AS BIGINT) AS review_ts,
       l_orderkey, l_linenumber, l_suppkey, l_extendedprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

COLLECTED = """
SELECT * FROM reviews WHERE review_ts < CAST(epoch(TIMESTAMP '1995-06-01') AS BIGINT)
"""

CATALOG = """
SELECT publisher, version, umbrella_item // 4 + 1 AS rank, umbrella_item AS item,
       round(avg(rating), 1) AS avg_rating,
       CAST(count(*) + (umbrella_item // 4) % 3 AS BIGINT) AS num_reviews
FROM reviews GROUP BY publisher, version, umbrella_item
"""

ALLOW = """
SELECT p_name AS title, p_partkey AS item FROM part
"""

RATINGS = """
SELECT publisher, user_id AS "user", umbrella_item AS item, rating,
       concat_ws('|', user_id, review_item, l_orderkey, l_linenumber) AS row_key
FROM reviews
"""

DOCUMENTS = """
SELECT doc_id, lang AS publisher, source AS version, text FROM documents
"""

VIEWS = {
    "reviews": REVIEWS,
    "collected": COLLECTED,
    "catalog": CATALOG,
    "allow": ALLOW,
    "ratings": RATINGS,
    "docs": DOCUMENTS,
}
DEPENDS = {"collected": ["reviews"], "catalog": ["reviews"], "ratings": ["reviews"]}


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with CTEs for the named views (dependencies first) and ``extra`` CTEs."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({VIEWS[n].strip()})" for n in order]
    ctes += [f"{n} AS ({sql.strip()})" for n, sql in (extra or [])]
    if not ctes:
        return body.strip()
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()
