"""Settings of one exchange's job. The jobs of two exchanges share nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tickflow.schemas import POLLED, PUSHED, TickFormat
from tickflow.session import SEOUL, STATE_PROVIDER, STATE_STORE, tick_session


@dataclass(frozen=True)
class JobConfig:
    """One tick job: message format, windows, and where its output goes."""

    name: str
    format: TickFormat
    output: str
    checkpoint: str
    zone: str = SEOUL
    duration: str = "1 minute"
    # How far ticks may be out of order. Spark measures it against the newest tick
    # of all topic partitions, so uneven partitions need a larger value.
    delay: str = "1 second"
    top: int = 5
    trigger: str = "1 minute"
    # Fixed for the life of a checkpoint: it is the number of state partitions.
    # By default that of the session.
    shuffle_partitions: int | None = None
    # Sums that do not depend on the order of addition. Fixed for the life of a checkpoint.
    exact: bool = False

    def session(self, spark: SparkSession) -> SparkSession:
        """A session for this job; its messages must be read with it."""
        return tick_session(spark, self.zone, self.shuffle_partitions)

    def check_zone(self, spark: SparkSession) -> None:
        """Refuse a session in another zone, which would publish under the wrong days."""
        zone = spark.conf.get("spark.sql.session.timeZone")
        if zone != self.zone:
            raise ValueError(f"job {self.name} is in zone {self.zone}, its session in {zone}")

    def check(self, spark: SparkSession) -> None:
        """Refuse a session in another zone, or one that keeps its state on the heap."""
        self.check_zone(spark)
        store = spark.conf.get(STATE_PROVIDER)
        if store != STATE_STORE:
            raise ValueError(f"job {self.name} needs its state in {STATE_STORE}, not {store}")


def exchange_a(output: str, checkpoint: str, **changes) -> JobConfig:
    """The job for the polled exchange."""
    return JobConfig(name="exchange-a", format=POLLED, output=output, checkpoint=checkpoint, **changes)


def exchange_b(output: str, checkpoint: str, **changes) -> JobConfig:
    """The job for the exchange that pushes its ticks."""
    return JobConfig(name="exchange-b", format=PUSHED, output=output, checkpoint=checkpoint, **changes)
