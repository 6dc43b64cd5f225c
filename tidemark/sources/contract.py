"""A typed record contract on JSON text, for tables and streams alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

# The scoring request's fields, their types and the defaults of those that may be absent.
REQUEST_FIELDS = {
    "Age": "bigint", "DailyRate": "bigint", "DistanceFromHome": "bigint", "Education": "string",
    "EnvironmentSatisfaction": "string", "JobInvolvement": "string", "JobLevel": "bigint", "JobSatisfaction": "string",
    "NumCompaniesWorked": "bigint", "PercentSalaryHike": "bigint", "PerformanceRating": "string",
    "RelationshipSatisfaction": "string", "StockOptionLevel": "bigint", "TotalWorkingYears": "bigint",
    "TrainingTimesLastYear": "bigint", "WorkLifeBalance": "string", "YearsAtCompany": "bigint", "MonthlyIncome": "bigint",
    "BusinessTravel": "string", "Department": "string", "EducationField": "string", "Gender": "string",
    "JobRole": "string", "MaritalStatus": "string", "OverTime": "string", "Batch_ID": "bigint",
    "EmployeeCount": "bigint", "EmployeeNumber": "bigint", "Over18": "string", "StandardHours": "bigint",
}
REQUEST_DEFAULTS = {"Batch_ID": None, "EmployeeCount": 1, "EmployeeNumber": 0, "Over18": "Y", "StandardHours": 80}


class RecordContract:
    """Field types, required fields and defaults of one kind of record."""

    def __init__(self, fields: dict[str, T.DataType], defaults: dict[str, object] | None = None):
        self.fields = fields
        self.defaults = defaults or {}
        self.required = [f for f in fields if f not in self.defaults]
        self.schema = T.StructType(
            [T.StructField(n, t) for n, t in fields.items()] + [T.StructField("_corrupt", T.StringType())]
        )

    def decode(self, df: DataFrame, column: str) -> DataFrame:
        """Add `record` (decoded, defaults filled) and `problems` (what is wrong with it)."""
        parsed = F.from_json(F.col(column), self.schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        # A generated column is computed once; a projected one would be parsed
        # again for every field that a later filter looks at.
        df = df.select("*", F.explode(F.array(parsed)).alias("_parsed"))
        get = lambda name: F.col("_parsed").getField(name)
        values = []
        for name, dtype in self.fields.items():
            default = self.defaults.get(name)
            value = get(name) if default is None else F.coalesce(get(name), F.lit(default).cast(dtype))
            values.append(value.alias(name))
        broken = F.col("_parsed").isNull() | get("_corrupt").isNotNull()
        missing = [F.when(get(n).isNull(), F.lit(f"missing {n}")) for n in self.required]
        problems = F.when(broken, F.array(F.lit("not decodable"))).otherwise(F.array_compact(F.array(*missing)))
        return df.withColumns({"record": F.struct(*values), "problems": problems}).drop("_parsed")

    def split(self, df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
        """(good rows with the record's fields, quarantined rows with their problems)."""
        decoded = self.decode(df, column)
        keep = [c for c in df.columns if c != column]
        good = decoded.filter(F.size("problems") == 0).select(*keep, "record.*")
        bad = decoded.filter(F.size("problems") > 0).select(*keep, column, "problems")
        return good, bad


def scoring_request() -> RecordContract:
    types = {"bigint": T.LongType(), "string": T.StringType()}
    return RecordContract({f: types[t] for f, t in REQUEST_FIELDS.items()}, REQUEST_DEFAULTS)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns a table lacks."""
    return [c for c in required if c not in df.columns]
