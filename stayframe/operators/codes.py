"""Flags and rules over code sets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from stayframe.functions.numeric import flag
from stayframe.functions.text import any_prefix, in_codes
from stayframe.operators.scale import MEASURE, Sizes, join_cohort, with_cohort


@dataclass(frozen=True)
class CodeRule:
    """A code matches when it is listed, starts with a prefix or lies in a text range."""

    exact: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    ranges: tuple[tuple[str, str], ...] = field(default=())

    def matches(self, code: Column, normalise: bool = False) -> Column:
        trimmed = F.trim(code) if normalise else code
        test = F.lit(False)
        if self.exact:
            test = test | in_codes(code, self.exact, normalise)
        if self.prefixes:
            test = test | any_prefix(trimmed, self.prefixes)
        for low, high in self.ranges:
            test = test | trimmed.between(low, high)
        return test


@dataclass(frozen=True)
class SepsisRule:
    """Infection with organ dysfunction or ventilation, or an explicit code."""

    infection: CodeRule
    organ_dysfunction: CodeRule
    explicit_sepsis: CodeRule
    mech_vent: CodeRule


def flags_per_key(codes: DataFrame, keys: DataFrame, by: str, rules: dict[str, CodeRule],
                  normalise: bool = False, sizes: Sizes = MEASURE) -> DataFrame:
    """One row per key that has codes: 1 when any of its codes matches the rule.

    The codes are joined to the keys first, so the rules only run on theirs.
    """
    code = F.col("icd9_code")
    found = join_cohort(codes.select(by, "icd9_code"), keys.select(by), [by], sizes=sizes)
    flags = [F.max(flag(rule.matches(code, normalise))).alias(n) for n, rule in rules.items()]
    return found.groupBy(by).agg(*flags)


def code_flags(cohort: DataFrame, codes: DataFrame, by: str, rules: dict[str, CodeRule],
               normalise: bool = False, sizes: Sizes = MEASURE) -> DataFrame:
    """Every cohort key with a 0/1 flag per rule."""
    found = flags_per_key(codes, cohort, by, rules, normalise, sizes)
    flags = [F.coalesce(name, F.lit(0)).alias(name) for name in rules]
    return cohort.select(by).join(found, by, "left").select(by, *flags)


def code_rule_score(cohort: DataFrame, admissions: DataFrame, diagnoses: DataFrame,
                    procedures: DataFrame, rule: SepsisRule, sizes: Sizes = MEASURE) -> DataFrame:
    """Severe-sepsis components and verdict for cohort admissions."""
    by, sizes = "hadm_id", with_cohort(sizes, cohort)
    from_diagnoses = {
        "infection": rule.infection,
        "explicit_sepsis": rule.explicit_sepsis,
        "organ_dysfunction": rule.organ_dysfunction,
    }
    diagnosed = flags_per_key(diagnoses, cohort, by, from_diagnoses, sizes=sizes)
    treated = flags_per_key(procedures, cohort, by, {"mech_vent": rule.mech_vent}, sizes=sizes)
    known = join_cohort(admissions.select(by), cohort.select(by), [by], sizes=sizes)
    names = [*from_diagnoses, "mech_vent"]
    rows_out = (
        cohort.select("subject_id", by, "icustay_id")
        .join(known, by)
        .join(diagnosed, by, "left")
        .join(treated, by, "left")
        .select("subject_id", by, "icustay_id",
                *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
    )
    infection, organ = F.col("infection") == 1, F.col("organ_dysfunction") == 1
    septic = (F.col("explicit_sepsis") == 1) | (infection & (organ | (F.col("mech_vent") == 1)))
    return rows_out.withColumn("angus", flag(septic))
