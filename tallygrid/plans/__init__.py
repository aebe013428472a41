"""A whole survey as one set of tables, built on demand, and how to store it."""

from tallygrid.plans.store import store_dataset, store_exports, store_results
from tallygrid.plans.survey import Survey, SurveyDesign

__all__ = ["Survey", "SurveyDesign", "store_dataset", "store_exports", "store_results"]
