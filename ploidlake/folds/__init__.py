"""Order-dependent steps as pure functions over one chromosome or one pair, wrapped once by the operators."""
