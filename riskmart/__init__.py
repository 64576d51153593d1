"""riskmart: a Spark-native batch pipeline for conflict and economic data.

Raw files (delimited text with decimal commas, SQL ``INSERT`` dumps, nested JSON
feeds) are read into date-partitioned Parquet, curated into typed tables and
turned into three ranked marts. Everything is DataFrame / Spark SQL code.

The most used entry points are importable from the package itself.
"""

__version__ = "0.1.0"

from riskmart.operators.marts import finance, government, humanitarian  # noqa: E402
from riskmart.operators.paging import page, page_mart  # noqa: E402
from riskmart.operators.ranking import asc, desc, global_rank  # noqa: E402
from riskmart.operators.text import word_count  # noqa: E402
from riskmart.plans.stages import run_all  # noqa: E402
from riskmart.sources.delimited import read_delimited  # noqa: E402
from riskmart.sources.dump import read_insert_dump  # noqa: E402

__all__ = ["asc", "desc", "finance", "global_rank", "government", "humanitarian", "page",
           "page_mart", "read_delimited", "read_insert_dump", "run_all", "word_count"]
