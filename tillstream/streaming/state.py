"""Stream operators that remember earlier rows, without dropping any.

Memory is kept in tables, not behind watermarks, so an answer does not depend on how the input is cut
into micro-batches or on the order in which rows arrive. A table's rows carry the number of the batch
that wrote them and a batch reads only those of earlier ones, so a replayed batch decides as it did
the first time. Pairs of orders and details are in ``pairs``, first orders in ``first_orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream import schemas
from tillstream.operators import dau, dims
from tillstream.sinks import tables as sink_tables

# Folders that user tables are dealt over by a hash of the user.
USER_SLOTS = 64


# ---- first visit of a device -------------------------------------------------------------

VISIT, VISIT_ORDER = ["dt", "mid"], ["ts"]


def store_visits(batch: DataFrame, n: int, table: str) -> None:
    """Add a micro-batch's earliest start log per (day, device) to the table of visits."""
    sink_tables.append_table(dau.first_visit(batch), table, n, "dt")


def read_visits(spark, table: str) -> DataFrame:
    """The earliest visit per (day, device) over all batches, late ones included."""
    return sink_tables.read_keyed(spark, table, schemas.DAU_INFO, VISIT, earliest=VISIT_ORDER)


# ---- users who have ordered (who is first: ``first_orders``) ------------------------------

def remember_users(flagged: DataFrame, batch_id: int, table: str) -> None:
    """Add the users whose first order the batch holds; all others are in the table already."""
    fresh = dims.user_state_rows(flagged.where(F.col("if_first_order") == "1"))
    sink_tables.upsert(fresh, table, ["user_id"], batch_id, slots=USER_SLOTS)
