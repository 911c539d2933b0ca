"""cinelake: a review data lake on Spark (batch questions, stream windows,
zone ETL), every operator a DataFrame -> DataFrame function."""

__version__ = "0.1.0"
