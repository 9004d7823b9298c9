"""traitlab: questionnaire analytics as Spark DataFrame operators.

Every operator takes and returns a Spark DataFrame (or a Column for the
scalar helpers in :mod:`traitlab.functions`).  Subpackages:

* ``sources``   - readers, writers, fixed dimensions, the survey view
* ``functions`` - Column-level helpers (scores, distances, argmin, ...)
* ``operators`` - cleaning, enrichment, sampling, features, clustering,
  classification, metrics, profiles, search
* ``plans``     - end-to-end flows composed from operators
* ``streaming`` - scoring of arriving responses
"""

__version__ = "0.1.0"
