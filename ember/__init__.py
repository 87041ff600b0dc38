"""ember: the reference's batch, SQL, streaming and ML jobs as PySpark
DataFrame / SQL / Structured Streaming / MLlib code."""

__version__ = "0.1.0"
