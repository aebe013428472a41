"""Trend analysis of stratified, repeated-count surveys on Spark."""

from tallygrid.plans.survey import Survey, SurveyDesign
from tallygrid.session import build_session, configure

__all__ = ["Survey", "SurveyDesign", "build_session", "configure"]
