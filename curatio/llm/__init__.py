"""Training-data operators: one module per operator, registered in
:mod:`curatio.llm.registry`. Nothing outside this package imports it."""
