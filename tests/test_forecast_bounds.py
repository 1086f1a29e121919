from salesflow.plans import queries as Q


def test_bounds_are_those_of_the_forecasts_themselves(spark, small, monkeypatch):
    asked = []
    fit = Q.FC.forecast_sales
    monkeypatch.setattr(Q.FC, "forecast_sales", lambda *args, **kw: asked.append(kw) or fit(*args, **kw))
    rows = Q.forecast_bounds(spark, small).collect()
    assert asked == [{}]
    assert rows and all(r["within"] for r in rows)
