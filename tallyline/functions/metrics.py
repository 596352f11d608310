"""The billed durations of the two usage reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.time import minimum_charge

SERVICE_MINIMUM = 10
TELEPHONY_MINIMUM = 60
CALLBACK = "CALLBACK"

# Columns the metrics are computed from, whatever table supplies them:
#   init_disc, sys_disc, xfer_disc   contact durations in seconds
#   leg_seconds                      connected-to-disconnected seconds of a leg


def contact_metrics() -> dict[str, Column]:
    """Columns of the contact-only report."""
    method = F.col("method")
    service = F.when(method != CALLBACK, F.col("init_disc")).when(method == CALLBACK, F.col("sys_disc"))
    return _with_minimums({
        "Connect_Service_Seconds": service,
        "Thirdparty_Telco_inSeconds": F.col("xfer_disc"),
        "CustomerCallLength_Telco_inSeconds": F.col("sys_disc"),
    })


def connection_metrics() -> dict[str, Column]:
    """Columns of the connection-level report.

    A callback counts only against its own leg, whereas every other contact
    without any leg still counts if it starts a chain; the two rules differ on
    purpose.
    """
    method, kind = F.col("method"), F.col("leg_type")
    own_leg = F.col("contact_id") == F.col("leg_id")
    customer_leg = own_leg | (F.col("leg_id").isNull() & F.col("initial_contact_id").isNull())
    service = F.when(customer_leg & (method != CALLBACK), F.col("init_disc")).when(
        own_leg & (method == CALLBACK), F.col("sys_disc"))
    desk_phone = F.when((kind == "agent") & (F.col("softphone") == F.lit(False)), F.col("leg_seconds"))
    other_party = F.when(
        (kind != "agent") & (F.col("leg_contact_id") != F.col("leg_id")),
        F.when(F.col("leg_disconnected").isNotNull(), F.col("leg_seconds")).otherwise(F.col("xfer_disc")))
    return _with_minimums({
        "Connect_Service_Seconds": service,
        "AgentDeskPhone_Telco_inSeconds": desk_phone,
        "Thirdparty_Telco_inSeconds": other_party,
        "CustomerCallLength_Telco_inSeconds": F.when(customer_leg, F.col("sys_disc")),
    })


def _with_minimums(measured: dict[str, Column]) -> dict[str, Column]:
    charged = {
        f"{name}_Rounded": minimum_charge(
            column, SERVICE_MINIMUM if name == "Connect_Service_Seconds" else TELEPHONY_MINIMUM)
        for name, column in measured.items()
    }
    return {**measured, **charged}
