"""Attenuation of X-rays in air, as numbers of the driver: one wavelength holds for a whole image."""

from __future__ import annotations

import math

import numpy as np

# Photon energies (eV) and mass attenuation coefficients (cm2/g) of the components of air.
ENERGIES = (1000, 1500, 2000, 3000, 4000, 5000, 6000, 8000, 10000, 15000, 20000, 30000, 40000, 50000, 60000, 80000, 100000)
COEFFICIENTS = {
    "N": (9.04e-1, 3.69e-1, 1.96e-1, 8.54e-2, 4.81e-2, 3.14e-2, 2.26e-2, 1.47e-2, 1.07e-2, 5.86e-3, 3.78e-3, 2.02e-3, 1.35e-3, 1.01e-3, 8.21e-4, 5.72e-4, 4.30e-4),
    "O": (1.18, 4.77e-1, 2.48e-1, 1.06e-1, 5.95e-2, 3.87e-2, 2.78e-2, 1.80e-2, 1.30e-2, 7.13e-3, 4.61e-3, 2.46e-3, 1.64e-3, 1.22e-3, 9.95e-4, 6.91e-4, 5.18e-4),
    "Ar": (8.21, 3.88, 2.14, 9.68e-1, 5.49e-1, 3.58e-1, 2.57e-1, 1.65e-1, 1.18e-1, 6.32e-2, 4.02e-2, 2.12e-2, 1.40e-2, 1.04e-2, 8.41e-3, 5.82e-3, 4.35e-3),
    "C": (6.36e-1, 2.71e-1, 1.49e-1, 6.82e-2, 3.95e-2, 2.60e-2, 1.89e-2, 1.25e-2, 9.14e-3, 5.08e-3, 3.29e-3, 1.76e-3, 1.18e-3, 8.84e-4, 7.19e-4, 5.01e-4, 3.76e-4),
}
# Composition of air, molar masses (g/mol), gas constant (L atm / (mol K)), hc (eV Angstrom).
COMPOSITION = {"N": 0.78084, "O": 0.20946, "Ar": 0.00934, "C": 0.00036}
MOLAR_MASSES = {"N": 14.0067, "O": 15.9994, "Ar": 39.948, "C": 12.0107}
GAS_CONSTANT = 0.08206
HC = 12398.4


def mass_attenuation(element: str, energy_ev: float) -> float:
    """Log-log interpolation, held at both ends of the table; 1e-3 for an element without data."""
    if element not in COEFFICIENTS:
        return 1e-3
    return math.exp(float(np.interp(math.log(energy_ev), np.log(ENERGIES), np.log(COEFFICIENTS[element]))))


def air_density(temperature_k: float = 293.15, pressure_atm: float = 1.0) -> float:
    """In g/cm3, of an ideal gas."""
    return pressure_atm * sum(f * MOLAR_MASSES[e] for e, f in COMPOSITION.items()) / (GAS_CONSTANT * temperature_k) / 1000.0


def air_attenuation(energy_ev: float, temperature_k: float = 293.15, pressure_atm: float = 1.0) -> float:
    """Linear coefficient of air per metre; 0.001 where the conditions make no sense."""
    if temperature_k <= 0 or energy_ev <= 0:
        return 0.001
    return 100.0 * air_density(temperature_k, pressure_atm) * sum(f * mass_attenuation(e, energy_ev) for e, f in COMPOSITION.items())
