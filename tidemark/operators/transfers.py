"""From a landed event log to net signed transfers per owner and block."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import evm, wide
from tidemark.functions.hexbytes import to_hex_text
from tidemark.operators.intervals import DEFAULT_CELL, points_inside
from tidemark.operators.scan import Run, running

# why an event is in quarantine
UNKNOWN = "unknown event"
TOO_LARGE = "amount out of range"
NO_AMOUNT = "no amount"


def decode(logs: DataFrame) -> DataFrame:
    """Add the event name, its one or two indexed addresses and its amount, and the reason if not all could be read."""
    word = F.substring("data", 1, 66)
    return _decoded(logs, evm.uint256(word), F.coalesce(evm.fits_decimal(word), F.lit(False)), TOO_LARGE)


def decode_wide(logs: DataFrame) -> DataFrame:
    """As ``decode``, with amounts of any size (``functions.wide``): only what is no event or no word is unreadable."""
    word = F.substring("data", 1, 66)
    return _decoded(logs, wide.from_word(word), wide.is_word(word), NO_AMOUNT)


def _decoded(logs: DataFrame, amount: Column, readable: Column, unreadable: str) -> DataFrame:
    name = evm.event_name(F.try_element_at("topics", F.lit(1)))
    first = evm.topic_address(F.try_element_at("topics", F.lit(2)))
    second = evm.topic_address(F.try_element_at("topics", F.lit(3)))
    return (
        logs.withColumns(
            {
                "address": F.lower("address"),
                "event_name": name,
                "first_party": first,
                "second_party": second,
                "amount": amount,
                "reason": F.when(name.isNull(), UNKNOWN).when(~readable, unreadable),
            }
        )
        .drop("topics", "data")
    )


def split_decodable(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable events, events that go to quarantine, with the ``reason``)."""
    return decoded.filter("reason IS NULL").drop("reason"), decoded.filter("reason IS NOT NULL")


def split_scalable(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events whose amount can be held in token units, the others with the ``reason``)."""
    fits = evm.fits_scaled(F.col("amount"), F.col("decimals"))
    return events.filter(fits), events.filter(~fits).withColumn("reason", F.lit(TOO_LARGE))


def relevant(decoded: DataFrame, products: DataFrame) -> DataFrame:
    """Events of known products, of the kinds their type uses, that were not reorganised away.

    ``products`` has chain, contract_address, product_id, decimals and ``stakes``: staking products emit
    Staked/Withdrawn, share products emit Transfer.
    """
    contract = products.select(
        "chain", F.lower("contract_address").alias("address"), "product_id", "decimals", "stakes"
    )
    kind = F.when(F.col("stakes"), F.col("event_name").isin("Staked", "Withdrawn")).otherwise(F.col("event_name") == "Transfer")
    return decoded.filter(~F.col("removed")).join(contract, ["chain", "address"]).filter(kind)


def to_legs(events: DataFrame) -> DataFrame:
    """Transfer: minus for the sender and plus for the receiver; Staked: plus; Withdrawn: minus.

    An amount that does not fit fails the job; ``split_scalable`` takes such events out first.
    """
    value = evm.scaled(F.col("amount"), F.col("decimals"))
    return _legs(events, value, -value)


def to_wide_legs(events: DataFrame) -> DataFrame:
    """As ``to_legs``, in chain integers of any size."""
    return _legs(events, F.col("amount"), wide.negated(F.col("amount")))


def _legs(events: DataFrame, value: Column, minus: Column) -> DataFrame:
    leg = lambda owner, amount: F.struct(F.col(owner).alias("owner_address"), amount.alias("amount_transferred"))
    legs = (
        F.when(
            F.col("event_name") == "Transfer", F.array(leg("first_party", minus), leg("second_party", value))
        )
        .when(F.col("event_name") == "Staked", F.array(leg("first_party", value)))
        .otherwise(F.array(leg("first_party", minus)))
    )
    return events.withColumn("_leg", F.explode(legs)).select(
        "chain",
        F.col("address").alias("token_address"),
        *[c for c in ("product_id",) if c in events.columns],
        F.col("decimals").alias("token_decimals"),
        F.lower("_leg.owner_address").alias("owner_address"),
        "block_number",
        "transaction_hash",
        F.col("_leg.amount_transferred").alias("amount_transferred"),
        "log_index",
    )


def as_stakes(legs: DataFrame, contract: Column) -> DataFrame:
    """Tokens sent to a staking contract are a position in it: reverse the sign, relabel the token."""
    return legs.withColumns({"token_address": contract, "amount_transferred": -F.col("amount_transferred")})


def net(legs: DataFrame, keys: Sequence[str] = ("chain", "token_address", "owner_address", "block_number")) -> DataFrame:
    """One signed amount per key; zero nets vanish.

    The transaction is the last one (by log index) that moved anything.
    """
    moved = F.when(F.col("amount_transferred") != 0, F.col("log_index"))
    # a missing amount makes its sum missing, so a strict reader sees it instead of a wrong net
    total = F.when(F.count("amount_transferred") == F.count(F.lit(1)), F.sum("amount_transferred"))
    return (
        legs.groupBy(*keys)
        .agg(
            total.cast("decimal(38,18)").alias("amount_transferred"),
            F.coalesce(F.max_by("transaction_hash", moved), F.max_by("transaction_hash", "log_index")).alias("transaction_hash"),
            F.max("log_index").alias("log_index"),
        )
        .filter(F.col("amount_transferred").isNull() | (F.col("amount_transferred") != 0))
    )


def net_wide(legs: DataFrame, keys: Sequence[str] = ("chain", "token_address", "owner_address", "block_number")) -> DataFrame:
    """As ``net``, of wide amounts: limbs are summed as they are, carries are made once per key."""
    amount = F.col("amount_transferred")
    moved = F.when(~wide.is_zero(amount), F.col("log_index"))
    sums = legs.groupBy(*keys).agg(
        wide.total(amount).alias("amount_transferred"),
        F.coalesce(F.max_by("transaction_hash", moved), F.max_by("transaction_hash", "log_index")).alias("transaction_hash"),
        F.max("log_index").alias("log_index"),
    )
    netted = sums.withColumn("amount_transferred", wide.normalised(amount))
    return netted.filter(~wide.known(amount) | ~wide.is_zero(amount))


def wide_running_balance(
    legs: DataFrame, keys: Sequence[str], order: Sequence[str], cell: Column, out: str = "balance"
) -> DataFrame:
    """Balance after each leg, limb by limb."""
    sums = {f"_run_{f}": Run("sum", F.col("amount_transferred")[f]) for f in wide.FIELDS}
    added = running(legs, keys, order, cell, sums)
    balance = F.struct(*(F.col(f"_run_{f}").alias(f) for f in wide.FIELDS))
    return added.withColumn(out, wide.normalised(balance)).drop(*sums)


def drop_ignored(transfers: DataFrame, ignored: DataFrame, owner: str = "owner_address") -> DataFrame:
    """Drop transfers of ignored owners of the same chain, whatever the letter case."""
    addresses = ignored.select("chain", F.lower(to_hex_text(F.col("address"))).alias("_owner")).distinct()
    return (
        transfers.withColumn("_owner", F.lower(owner)).join(addresses, ["chain", "_owner"], "left_anti").drop("_owner")
    )


def inside_requested(
    transfers: DataFrame, requested: DataFrame, keys: Sequence[str], position: str = "block_number", cell_width: int = DEFAULT_CELL
) -> DataFrame:
    """Keep what lies in its own key's requested ranges: one wide scan serves keys with different ranges."""
    return points_inside(transfers, requested, keys, position, cell_width=cell_width)
