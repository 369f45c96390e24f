"""Documents of unlike types, and views with parameters for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.functions import variants
from ampertide.sources.sinks import table_function
from proofs.registry import Tables, proof

# One field as number, numeric text, other text, null, decimal, list, or not there at all.
_PRICE = (
    "CASE p_size % 7 WHEN 0 THEN '{\"price\": ' || p_size || '}' WHEN 1 THEN '{\"price\": \"' || p_size || '\"}'"
    " WHEN 2 THEN '{\"price\": \"on request\"}' WHEN 3 THEN '{\"price\": null}' WHEN 4 THEN '{\"price\": ' || p_size || '.25}'"
    " WHEN 5 THEN '{\"price\": [' || p_size || ']}' ELSE '{\"name\": \"none\"}' END"
)


@proof(
    f"""
    WITH d AS (SELECT p_partkey, json_type(doc, '$.price') AS kind, json_extract_string(doc, '$.price') AS v
               FROM (SELECT p_partkey, CAST({_PRICE} AS JSON) AS doc FROM part))
    SELECT p_partkey,
           CASE WHEN kind IS NULL THEN 'missing' WHEN kind = 'NULL' THEN 'null' WHEN kind = 'VARCHAR' THEN 'text'
                WHEN kind = 'ARRAY' THEN 'array' ELSE 'number' END AS kind,
           CASE WHEN kind IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN CAST(v AS DOUBLE) END AS price,
           COALESCE(kind IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND TRY_CAST(v AS DOUBLE) > 10, FALSE) AS above_ten,
           COALESCE(kind = 'VARCHAR' AND v > '10', FALSE) AS text_above_ten,
           NOT COALESCE(kind = 'VARCHAR' AND v = 'on request', FALSE) AS priced
    FROM d
    """
)
def documents_of_unlike_types(t: Tables) -> DataFrame:
    doc = F.col("doc")
    return t.part.select("p_partkey", variants.document(F.expr(_PRICE)).alias("doc")).select(
        "p_partkey",
        variants.kind(doc, "$.price").alias("kind"),
        variants.number(doc, "$.price").alias("price"),
        variants.exceeds(doc, "$.price", 10.0).alias("above_ten"),
        variants.exceeds(doc, "$.price", "10").alias("text_above_ten"),
        variants.differs(doc, "$.price", "on request").alias("priced"),
    )


@proof(
    """
    SELECT 'one status' AS call, o_orderstatus AS status, COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F' AND YEAR(o_orderdate) = 2000 GROUP BY 2
    UNION ALL SELECT 'all', o_orderstatus, COUNT(*) FROM orders WHERE YEAR(o_orderdate) = 2000 GROUP BY 2
    UNION ALL SELECT 'any year', o_orderstatus, COUNT(*) FROM orders WHERE o_orderstatus = 'O' GROUP BY 2
    """
)
def parameter_view(t: Tables) -> DataFrame:
    """A view whose parameters may be left out, called in three ways."""
    t.orders.createOrReplaceTempView("_orders")
    table_function(
        t.spark,
        "orders_of",
        {"status": ("STRING", "NULL"), "year": ("INT", "2000")},
        """SELECT * FROM _orders AS o WHERE (orders_of.status IS NULL OR o.o_orderstatus = orders_of.status)
           AND (orders_of.year IS NULL OR YEAR(o.o_orderdate) = orders_of.year)""",
    )
    calls = {"one status": "status => 'F'", "all": "", "any year": "year => NULL, status => 'O'"}
    return t.spark.sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS call, o_orderstatus AS status, COUNT(*) AS n FROM orders_of({call}) GROUP BY 2" for name, call in calls.items()
        )
    )
