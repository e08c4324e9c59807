"""elcorpus: build an entity-linking corpus from encyclopedia HTML and a
knowledge-base dump, expressed as Spark DataFrame jobs.

Sub-packages:
  sources    - schema-first readers for every stage input
  sinks      - writers for every stage output
  functions  - Column-valued scalar helpers (titles, URLs, entities, JSON)
  operators  - DataFrame -> DataFrame operators (HTML token table, joins)
  plans      - the composite stages of the pipeline
  streaming  - the incremental (Structured Streaming) cleaning stage
"""

__version__ = "0.1.0"
