"""Views, projections and schema conformance (the table-API side of the SQL join)."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidal import schemas

log = logging.getLogger(__name__)

USER_VIEW = "UserTable"
ACTION_VIEW = "ActionTable"


def register_views(users: DataFrame, actions: DataFrame, user_view: str = USER_VIEW,
                   action_view: str = ACTION_VIEW, replace: bool = False) -> None:
    """Register the two inputs as temporary views and log their schemas.

    Without ``replace`` an existing view name is an error, like creating a temporary view twice.
    """
    for df, name in ((users, user_view), (actions, action_view)):
        log.info("schema of %s: %s", name, df.schema.simpleString())
        if replace:
            df.createOrReplaceTempView(name)
        else:
            df.createTempView(name)


def project_user(users: DataFrame) -> DataFrame:
    return users.select("userId", "name")


def project_action(actions: DataFrame) -> DataFrame:
    return actions.select("userId", "action")


def conform(df: DataFrame, schema: T.StructType = schemas.USER_ACTION) -> DataFrame:
    """Columns matched to ``schema`` by name (reordered, types checked and up-cast)."""
    return df.to(schema)
