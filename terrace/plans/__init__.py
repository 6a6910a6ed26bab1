"""Table graphs: how layers are built from specs, and the declared racing tables."""
