"""Training-data operators (one module per operator). Nothing else in the library imports this
subpackage; ``queries.py`` registers one thin query per operator."""
