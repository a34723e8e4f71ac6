"""mvtax - a Spark-native multi-view spectral clustering and taxonomy engine.

Subpackages: ``sources`` (scans, sinks, fixtures), ``functions`` (Column expressions),
``operators`` (kNN join, graph algebra, spectral embedding, clustering, profiles, rules),
``plans`` (level, hierarchy, labelling, end-to-end taxonomy), ``streaming`` (none needed).
"""

__version__ = "0.1.0"
