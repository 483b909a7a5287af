"""Writers: JSON, manifests, energy-model XML, and publishing only what passed."""
