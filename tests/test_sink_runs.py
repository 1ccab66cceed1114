"""F8: a run of the feature sink derives its own symbols' features and stores them, once."""

from panelkit.plans import features as FT
from panelkit.plans import queries as Q
from panelkit.sources import sinks as SK


def test_runs_derive_their_own_symbols(spark, sf, monkeypatch):
    """No table beside the sink's; the first two runs share the symbols out, the third has nothing to derive."""
    tables, derived, written = [], [], []
    derive, write = FT.bar_features, SK.write_features
    monkeypatch.setattr(Q, "store", lambda *a, **k: tables.append(a))
    monkeypatch.setattr(FT, "bar_features", lambda bars, *a, **k: derived.append(bars) or derive(bars, *a, **k))
    monkeypatch.setattr(SK, "write_features", lambda df, path, run=0, **k: written.append(run) or write(df, path, run=run, **k))
    runs = {r["symbol"]: r for r in Q.q_feature_sink(spark, sf).collect()}
    assert written == [0, 1] and not tables
    symbols = [{r[0] for r in bars.select("symbol").distinct().collect()} for bars in derived]
    assert not symbols[0] & symbols[1] and symbols[0] | symbols[1] == set(runs)
    assert all(r["run"] == (0 if s in symbols[0] else 1) and r["n_rows"] == r["n_stored"] for s, r in runs.items())
