"""A calibrated text-and-number classifier for review triage, and seeded text noise for benches."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class TriageModel:
    """Character trigrams (TF-IDF) and standardised numbers into a logistic regression, then Platt's calibration on held-out rows."""

    def __init__(self, text: str, numbers: list[str], label: str, slots: int = 4096):
        self.text, self.numbers, self.label = text, numbers, label
        self.stages = Pipeline(
            stages=[
                RegexTokenizer(inputCol="_text", outputCol="_c", pattern=".", gaps=False, toLowercase=True),
                NGram(n=3, inputCol="_c", outputCol="_g"),
                HashingTF(inputCol="_g", outputCol="_tf", numFeatures=slots),
                IDF(inputCol="_tf", outputCol="_idf"),
                VectorAssembler(inputCols=[f"_{n}" for n in numbers], outputCol="_numbers"),
                StandardScaler(inputCol="_numbers", outputCol="_s", withMean=True),
                VectorAssembler(inputCols=["_idf", "_s"], outputCol="_x"),
                LogisticRegression(featuresCol="_x", labelCol="_y", regParam=0.01, rawPredictionCol="_raw", probabilityCol="_p", predictionCol="_z"),
            ]
        )
        self.platt = LogisticRegression(featuresCol="_v", labelCol="_y", probabilityCol="_q", rawPredictionCol="_r", predictionCol="_c2")

    def _rows(self, rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_text", F.coalesce(self.text, F.lit(""))).withColumns({f"_{n}": F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in self.numbers})
        return rows.withColumn("_y", F.col(self.label).cast("double")) if self.label in rows.columns else rows

    def fit(self, rows: DataFrame) -> "TriageModel":
        rows = self._rows(rows).withColumn("_hold", F.pmod(F.xxhash64("_text", "_y", *[f"_{n}" for n in self.numbers]), F.lit(4)) == 0)
        self.model = self.stages.fit(rows.where("not _hold"))
        held = self._logit(self.model.transform(rows.where("_hold")))
        self.calibration = self.platt.fit(VectorAssembler(inputCols=["_l"], outputCol="_v").transform(held))
        return self

    @staticmethod
    def _logit(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_l", vector_to_array("_raw")[1])

    def predict(self, rows: DataFrame) -> DataFrame:
        """rows with probability (of label 1)."""
        out = VectorAssembler(inputCols=["_l"], outputCol="_v").transform(self._logit(self.model.transform(self._rows(rows))))
        out = self.calibration.transform(out).withColumn("probability", vector_to_array("_q")[1])
        return out.select(*rows.columns, "probability")


def degrade(rows: DataFrame, text: str, id: str, rate: float, seed: str = "noise") -> DataFrame:
    """rows whose text has some letters read wrongly, the same ones for the same seed and id."""
    swap = F.create_map(*[F.lit(x) for kv in {"O": "0", "0": "O", "I": "1", "1": "I", "S": "5", "5": "S", "B": "8", "8": "B", "E": "F", "M": "N"}.items() for x in kv])
    chars = F.split(F.col(text), "")
    hit = lambda c, i: F.pmod(F.xxhash64(F.lit(seed), F.col(id), i), F.lit(1000)) < int(rate * 1000)
    return rows.withColumn(text, F.when(F.col(text) == "", "").otherwise(F.array_join(F.transform(chars, lambda c, i: F.when(hit(c, i), F.coalesce(F.try_element_at(swap, F.upper(c)), c)).otherwise(c)), "")))
