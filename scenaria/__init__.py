"""Scenario time-series preparation, sampling, scoring and evaluation on Spark DataFrames."""

from scenaria.roles import Roles
from scenaria.session import get_spark, checkpoint_dir

__all__ = ["Roles", "get_spark", "checkpoint_dir"]
