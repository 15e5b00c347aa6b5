from datetime import datetime, timedelta, timezone

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)


def at(slots, minutes=15):
    return T0 + timedelta(minutes=minutes * slots)


def series(spark, values, site="a", parameter="DO", minutes=15, extra=None):
    rows = [(site, parameter, at(i, minutes), v, *(extra[i] if extra else ())) for i, v in enumerate(values)]
    cols = "site string, parameter string, dt_round timestamp, mean double"
    return spark.createDataFrame(rows, cols + (", flag string" if extra else ""))


def column(df, name, order="dt_round"):
    return [r[name] for r in df.orderBy(order).collect()]
