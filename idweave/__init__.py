"""Record linkage on Spark: match an incomplete table of people to a registry."""

from idweave.plans.linkage import LinkageResult, link
from idweave.spec import FUZZY_RULES, RULES, FuzzyRule, LinkageSpec, Rule

__all__ = ["FUZZY_RULES", "RULES", "FuzzyRule", "LinkageResult", "LinkageSpec", "Rule", "link"]
