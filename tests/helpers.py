"""What the tests share: small tables, sorted rows and plans that ran."""

SF = "/root/testdata/sf0.001"


def rows(frame):
    """Rows as a sorted list of tuples, None first."""
    return sorted(map(tuple, frame.collect()), key=lambda r: [(x is not None, x) for x in r])


def plan(frame):
    """The physical plan that actually ran."""
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


PAYMENT = "order_id bigint, pay_amount double, pay_source smallint, pay_platform smallint, create_time bigint"
SLIM = "order_id bigint, plat string, total_price double"


def payments(spark, *items):
    """Payments from (order id, amount, terminal, create time) tuples."""
    data = [(o, float(a), i % 4, t, at) for i, (o, a, t, at) in enumerate(items)]
    return spark.createDataFrame(data, PAYMENT)


def slim(spark, *items):
    return spark.createDataFrame([(o, p, float(t)) for o, p, t in items], SLIM)
