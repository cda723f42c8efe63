import __spark_entry__ as E


def test_entry_runs_with_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["rang", "condition", "prix_km_moyen", "courses", "ecart_pct", "au_dessus"]
    assert len(rows) > 0
    assert [r.rang for r in rows] == sorted(r.rang for r in rows)


def test_registry_names_are_unique_and_callable():
    qs = E.queries()
    assert len(qs) >= 100
    assert all(callable(f) for f in qs.values())
