"""DataFrame-in, DataFrame-out operators, grouped as in the survey inventory:

* ``prep``        P1-P7, A6-A9  projections, filters, labels, key-hash splits
* ``text``        X1-X8         cleaning, tokens, stop words, hashed counts, IDF
* ``features``    F1-F6         index, one-hot, buckets, assembly
* ``models``      M1-M11        model families and fit-then-score
* ``introspect``  I1-I7         learned state as tables
* ``evaluate``    A1-A5, E1-E4  confusion counts and metrics
* ``forests``     T10           forest search on grouped rows
* ``tune``        T1-T12        pipelines, grids, cross-validated search
"""
