from collections import Counter


def rows(df, *columns):
    """Rows as a multiset of tuples, of some columns or all."""
    return Counter(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def plan(df):
    """The physical plan, before it runs."""
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df):
    """The physical plan with what adaptive execution made of it."""
    execution = df._jdf.queryExecution()
    df._jdf.queryExecution().executedPlan().execute().count()
    return execution.executedPlan().toString()


class settings:
    """Some session settings for the length of a block."""

    def __init__(self, spark, values):
        self.spark, self.values = spark, values

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self.values}
        for k, v in self.values.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
