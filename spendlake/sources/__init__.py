"""Where rows come from: JSON exports, and star-schema tables reshaped like them."""
