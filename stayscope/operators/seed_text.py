"""A little text in seven languages, written for this package."""

SEED_TEXT = {
    "en": [
        "Everyone at the reception smiled, the towels were fresh and our suitcases were carried upstairs.",
        "We had a great time at this hotel and would come back again with the children next year.",
        "Breakfast was cold, the service was slow, and nobody answered the phone at the front desk.",
        "The location is perfect, close to the beach and within walking distance of many restaurants.",
        "Our bathroom was dirty, the shower did not work and there was a lot of noise from the street.",
        "I would not recommend this place to anyone who wants to sleep well at night.",
        "Check in was quick and easy, the bed was comfortable and the pool area was lovely.",
        "They should have told us that the parking costs extra and that the elevator was broken.",
        "What a wonderful view from the balcony, with the sun going down behind the mountains.",
        "It was good value for the money, although the walls are thin and the carpet looked old.",
        "Terrible experience. Never again. The manager was rude when we asked for another room.",
        "Nice pool, good food, quiet rooms and free coffee in the lobby every morning.",
    ],
    "de": [
        "An der Rezeption lächelten alle, die Handtücher waren frisch und die Koffer trug man uns hinauf.",
        "Wir hatten eine schöne Zeit in diesem Hotel und würden nächstes Jahr gerne wiederkommen.",
        "Das Frühstück war kalt, die Bedienung langsam, und niemand ging an der Rezeption ans Telefon.",
        "Die Lage ist perfekt, nahe am Strand und nicht weit von vielen guten Restaurants entfernt.",
        "Unser Badezimmer war schmutzig, die Dusche funktionierte nicht und von der Straße kam Lärm.",
        "Ich kann dieses Haus niemandem empfehlen, der nachts gut schlafen möchte.",
        "Die Anmeldung ging schnell und einfach, das Bett war bequem und der Garten wunderschön.",
        "Man hätte uns sagen sollen, dass der Parkplatz extra kostet und der Aufzug kaputt ist.",
        "Was für eine herrliche Aussicht vom Balkon, wenn die Sonne hinter den Bergen untergeht.",
        "Einmal und nicht noch einmal: Der Leiter wurde laut, als wir um andere Betten gebeten haben.",
        "Für den Preis war es gut, obwohl die Wände dünn sind und der Teppich alt aussah.",
        "Schönes Schwimmbad, gutes Essen, ruhige Zimmer und jeden Morgen kostenloser Kaffee.",
    ],
    "fr": [
        "La chambre était très propre et le personnel a été aimable pendant tout notre séjour.",
        "Nous avons passé un bon moment dans cet hôtel et nous reviendrons avec les enfants.",
        "Le petit déjeuner était froid, le service lent, et personne ne répondait à la réception.",
        "L'emplacement est parfait, près de la plage et à quelques pas de nombreux restaurants.",
        "Notre salle de bain était sale, la douche ne marchait pas et il y avait du bruit dans la rue.",
        "Je ne recommande cet endroit à personne qui souhaite bien dormir la nuit.",
        "L'arrivée a été rapide et facile, le lit confortable et le jardin était magnifique.",
        "On aurait dû nous dire que le parking est payant et que l'ascenseur est en panne.",
        "Quelle vue merveilleuse depuis le balcon, avec le soleil qui se couche derrière les montagnes.",
        "Mauvaise expérience. Plus jamais. Le directeur a été impoli quand nous avons voulu changer.",
        "Bon rapport qualité prix, même si les murs sont minces et que la moquette est vieille.",
        "Belle piscine, bonne cuisine, chambres calmes et café gratuit tous les matins.",
    ],
    "es": [
        "La habitación estaba muy limpia y el personal fue amable durante toda nuestra estancia.",
        "Lo pasamos muy bien en este hotel y volveremos el año que viene con los niños.",
        "El desayuno estaba frío, el servicio era lento y nadie contestaba en la recepción.",
        "La ubicación es perfecta, cerca de la playa y a pocos pasos de muchos restaurantes.",
        "Nuestro baño estaba sucio, la ducha no funcionaba y había mucho ruido en la calle.",
        "No recomiendo este lugar a nadie que quiera dormir bien por la noche.",
        "La llegada fue rápida y fácil, la cama era cómoda y el jardín estaba precioso.",
        "Deberían habernos dicho que el aparcamiento se paga y que el ascensor está averiado.",
        "Qué vista tan maravillosa desde el balcón, con el sol poniéndose detrás de las montañas.",
        "Mala experiencia. Nunca más. El encargado fue grosero cuando pedimos otra habitación.",
        "Buena relación entre calidad y precio, aunque las paredes son finas y la alfombra vieja.",
        "Bonita piscina, buena comida, habitaciones tranquilas y café gratis todas las mañanas.",
    ],
    "it": [
        "La camera era molto pulita e il personale è stato gentile durante tutto il soggiorno.",
        "Ci siamo trovati bene in questo albergo e torneremo l'anno prossimo con i bambini.",
        "La colazione era fredda, il servizio lento e nessuno rispondeva alla reception.",
        "La posizione è perfetta, vicino alla spiaggia e a pochi passi da molti ristoranti.",
        "Il nostro bagno era sporco, la doccia non funzionava e c'era molto rumore dalla strada.",
        "Non consiglio questo posto a nessuno che voglia dormire bene di notte.",
        "L'arrivo è stato facile e veloce, il letto era comodo e il giardino bellissimo.",
        "Avrebbero dovuto dirci che il parcheggio si paga e che l'ascensore è rotto.",
        "Che vista meravigliosa dal balcone, con il sole che scende dietro le montagne.",
        "Brutta esperienza. Mai più. Il direttore è stato scortese quando abbiamo chiesto di cambiare.",
    ],
    "pt": [
        "O quarto estava muito limpo e os funcionários foram simpáticos durante toda a estadia.",
        "Passamos um ótimo tempo neste hotel e voltaremos no próximo ano com as crianças.",
        "O café da manhã estava frio, o serviço era lento e ninguém atendia na recepção.",
        "A localização é perfeita, perto da praia e a poucos passos de muitos restaurantes.",
        "O nosso banheiro estava sujo, o chuveiro não funcionava e havia muito barulho na rua.",
        "Não recomendo este lugar a ninguém que queira dormir bem à noite.",
        "A chegada foi rápida e fácil, a cama era confortável e o jardim estava lindo.",
        "Deviam ter avisado que o estacionamento é pago e que o elevador não está funcionando.",
        "Que vista maravilhosa da varanda, com o sol se pondo atrás das montanhas.",
        "Má experiência. Nunca mais. O gerente foi grosseiro quando pedimos outro quarto.",
    ],
    "nl": [
        "De kamer was erg schoon en het personeel was vriendelijk tijdens ons hele verblijf.",
        "We hebben het goed gehad in dit hotel en komen volgend jaar terug met de kinderen.",
        "Het ontbijt was koud, de bediening was traag en niemand nam de telefoon op bij de balie.",
        "De ligging is perfect, dicht bij het strand en op loopafstand van veel restaurants.",
        "Onze badkamer was vies, de douche werkte niet en er kwam veel lawaai van de straat.",
        "Ik kan deze plek niemand aanraden die 's nachts goed wil slapen.",
        "Het inchecken ging snel en gemakkelijk, het bed was heerlijk en de tuin prachtig.",
        "Ze hadden ons moeten zeggen dat parkeren extra kost en dat de lift kapot is.",
        "Wat een prachtig uitzicht vanaf het balkon, met de zon die achter de bergen ondergaat.",
        "Slechte ervaring. Nooit meer. De chef was onbeleefd toen we een andere kamer vroegen.",
    ],
}
