"""The declared tables of the racing lakehouse: three sources, silver tables, a gold star."""

from terrace.plans.racing.specs import gold_specs, silver_specs
from terrace.plans.racing.topics import RECORDS, TOPICS

__all__ = ["RECORDS", "TOPICS", "gold_specs", "silver_specs"]
