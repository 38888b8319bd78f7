"""DataFrame-in, DataFrame-out reconciliation operators; none of them runs an action unless its docstring says so."""
