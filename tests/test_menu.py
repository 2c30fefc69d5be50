"""The sort menu reads names once and sorts narrow rows."""

from __future__ import annotations

from penmark.operators import positions, registry


def test_each_sort_moves_its_own_column(spark, monkeypatch):
    files = spark.createDataFrame(
        [(f"model_save/{i}/rnn_{50 + i % 7}.5_2024-01-{1 + i % 28:02d}_10-00-00.pt" if i % 5 else f"model_save/{i}/run{i}.pt", i * 77_777) for i in range(60)],
        "path STRING, size BIGINT")
    models = registry.catalogue(files)
    stored, write = [], positions.materialise
    monkeypatch.setattr(positions, "materialise", lambda df: stored.append(set(df.columns)) or write(df))
    got = registry.ranked_each(models).collect()
    assert stored == [{"path", column, "_at"} for column in registry.MENU.values()]
    for choice in registry.MENU:
        want = [r.path for r in models.orderBy(*registry.order_of(choice)).collect()]
        assert [r.path for r in sorted((r for r in got if r.sort_by == choice), key=lambda r: r["rank"])] == want
