"""Rule catalogues and the train / score flows built from the operators."""
