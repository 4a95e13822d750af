"""satlens: Spark-native satisfaction-score (NPS) driver analytics.

DataFrame -> DataFrame operators for: survey ingestion and cleaning, joins
with operational tables, audits, deduplication, imputation, splits, MLlib
promoter / detractor classifiers, per-respondent contributions with
uncertainty, period / segment explanations, period comparisons, adjustments
and trust grading.
"""

__version__ = "0.1.0"
