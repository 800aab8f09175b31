"""Training-data operators: ten independent operators and their registered queries."""
