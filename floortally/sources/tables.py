"""The input tables by role, read lazily so a report only touches what it needs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "interaction_flags": """id bigint, interaction_id bigint, sales_outcome string, type_of_interaction string,
        primary_category_new string, reason_loss_of_sale string, customer_objection_handling string""",
    "scheme_flags": "id bigint, interaction_id bigint, sop_new string",
    "interactions": """id bigint, audio_url string, interaction_code string, start_time timestamp_ntz,
        end_time timestamp_ntz, date date, duration string, sales_person_id bigint, store_id bigint,
        path string, sales_outcome string, phone_number_discussion string, reason_loss_of_sale string,
        customer_objection_handling string""",
    "audio_files": """id bigint, path string, filename string, date date, createddate date, duration string,
        speech_duration string, sales_person_id bigint""",
    "sales_persons": "id bigint, name string, email string, employee_id string, store_id bigint",
    "stores": "id bigint, name string, brand_id int, abm_id bigint, regional_manager_id int",
    "managers": "id bigint, user_id bigint",
    "users": "id bigint, name string",
    "brands": "id int, name string",
    "salesperson_stores": "sp_id bigint, store_id bigint, start_date date, end_date date",
    "devices": """name string, store_id bigint, sales_person_id bigint, assigned_on date, unassigned_on date,
        comments string""",
    "device_registrations": "name string, store_id bigint, brand_id int",
    "attendance": "UserID string, InDateTime string, OutDateTime string, Date string, day date",
}


class Tables:
    """Roles as attributes: `tables.interactions` is a DataFrame."""

    def __init__(self, loaders: Mapping[str, Callable[[], DataFrame]]):
        self._loaders = dict(loaders)

    def __getattr__(self, role: str) -> DataFrame:
        try:
            return self.__dict__["_loaders"][role]()
        except KeyError:
            raise AttributeError(f"no table bound to {role!r}") from None

    def __contains__(self, role: str) -> bool:
        return role in self._loaders

    def bind(self, **frames: DataFrame) -> Tables:
        """A copy with some roles served by the given frames."""
        return Tables({**self._loaders, **{role: (lambda frame=frame: frame) for role, frame in frames.items()}})


def parquet_tables(spark: SparkSession, root: str) -> Tables:
    """One Parquet dataset per role under `root`; facts partitioned by `date` are pruned."""
    return Tables(
        {
            role: (lambda role=role: spark.read.schema(SCHEMAS[role]).parquet(f"{root}/{role}"))
            for role in SCHEMAS
        }
    )


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Database table read by `partitions` parallel range scans on an integer key."""
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )
