"""Batch analytics over the activity records of a data-annotation operation.

Layers, lowest first:

* ``functions`` - column expressions (text, time, numbers, JSON);
* ``operators`` - DataFrame transformations (scope, versions, sequence, counts, shares);
* ``sources``   - table schemas, loading, renaming;
* ``plans``     - the five reports, composed from the above.
"""
