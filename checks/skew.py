"""Timing under skew: ``python -m checks.skew [sf_dir] [copies]``.

Multiplies lineitem into a multi-source table in which one person holds a third of all rows, half of these equal to
one another, and times the plans of selection, flowchart and ranks. The usual three-window selection is left out: it
copies the array of all tied rows into every one of them and did not finish within twelve minutes on 7.2 million rows.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import functions as F

import recordloom as rl
from bench import unpivoted_flowchart
from checks.compare import local_session
from checks.queries import scratch
from checks.views import table


def main(sf_dir: str = "/root/testdata/sf0.1", copies: str = "10") -> None:
    spark = local_session()
    path = scratch(spark)
    times = spark.range(int(copies)).withColumnRenamed("id", "copy")
    table(spark, sf_dir, "lineitem").crossJoin(F.broadcast(times)).selectExpr(
        "l_orderkey * 1000 + l_linenumber * 100 + copy as row_id",
        "if(copy % 3 = 0, 'hot', cast(l_orderkey as string)) as person_id",
        """if(copy % 6 = 0, date '2001-12-31',
              date_sub(cast(l_shipdate as date), cast(copy * 7 as int))) as record_date""",
        "if(copy % 6 = 0, '1', cast(l_partkey % 3 as string)) as sex_code",
        "if(copy % 6 = 0, 'M', element_at(array('M', 'F', 'I'), cast(l_partkey % 3 + 1 as int))) as sex",
        """if(copy % 6 = 0, 'gdppr', element_at(array('gdppr', 'hes_apc', 'hes_op', 'hes_ae', 'ssnap'),
              cast(l_linenumber % 5 + 1 as int))) as data_source""",
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    print(f"rows {rows.count()}, of the hot person {rows.filter(F.col('person_id') == 'hot').count()}", flush=True)

    def run(name, df_of):
        start = time.perf_counter()
        df_of().write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - start:.1f} s", flush=True)

    criteria = {"known": "sex is not null", "recent": "record_date >= date '1998-01-01'", "male": "sex = 'M'"}
    long = rows.drop("row_id")
    cohort = rows.withColumn("person_id", F.nullif("person_id", F.lit("hot")))
    for _ in range(2):  # the first round warms up
        run("selection", lambda: rl.select_sex(long))
        run("flowchart", lambda: rl.inclusion_flowchart(rl.flag_inclusion(cohort, criteria), criteria))
        run("flowchart, usual shape", lambda: unpivoted_flowchart(cohort, criteria))
        ranked = {"partition_by": "person_id", "order_by": "record_date desc"}
        run("first dense rank, window", lambda: rl.first_dense_rank(rows, **ranked))
        run("first dense rank, heavy ties", lambda: rl.first_dense_rank(rows, heavy_ties=True, **ranked))


if __name__ == "__main__":
    main(*sys.argv[1:])
